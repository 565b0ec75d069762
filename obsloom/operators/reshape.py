"""Tall and narrowed forms of a wide fact table. No shuffle in any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.functions.numeric import rounded_small, rounded_unsigned_small


def unpivot_metrics(
    df: DataFrame, ids: list[str], metrics: list[str], name_as: str = "metric_name", value_as: str = "metric_value"
) -> DataFrame:
    """One row per id columns and metric, nulls kept."""
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ids, metrics, name_as, value_as
    )


def serve_float(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Metrics as 32-bit floats."""
    return df.select(*keys, *[F.col(m).cast("float").alias(m) for m in metrics])


def serve_compact(
    df: DataFrame,
    keys: list[str],
    *,
    small: list[str],
    rounded_float: list[str],
    plain_float: list[str],
    unsigned: list[str],
) -> DataFrame:
    """Rounded 16-bit integers, floats and unsigned small integers; out-of-range values raise."""
    return df.select(
        *keys,
        *[rounded_small(m).alias(m) for m in small],
        *[F.round(m, 0).cast("float").alias(m) for m in rounded_float],
        *[F.col(m).cast("float").alias(m) for m in plain_float],
        *[rounded_unsigned_small(m).alias(m) for m in unsigned],
    )
