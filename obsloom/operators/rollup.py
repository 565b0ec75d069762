"""Rollup of a finer time series to one row per key and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.functions.keys import surrogate_key

_AGGREGATES = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def measures(spec: list[tuple[str, str, str]]) -> list[Column]:
    """Aggregates from (output, function, column) triples."""
    return [_AGGREGATES[function](column).alias(out) for out, function, column in spec]


def rollup_daily(
    df: DataFrame,
    *,
    key: str,
    time: str,
    date_as: str,
    spec: list[tuple[str, str, str]],
    key_name: str = "station_date_id",
) -> DataFrame:
    """One row per key and day. All measures combine on the map side before the one shuffle."""
    daily = df.groupBy(key, F.col(time).cast("date").alias(date_as)).agg(*measures(spec))
    return daily.select(surrogate_key([key, date_as]).alias(key_name), "*")
