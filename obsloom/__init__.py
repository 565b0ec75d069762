"""Data operators for keyed observation time series, written as Spark DataFrame functions."""

__version__ = "0.1.0"
