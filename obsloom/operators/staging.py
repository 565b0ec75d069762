"""Staging: rename, convert, cast and key raw columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.functions.keys import surrogate_key
from obsloom.functions.numeric import c_to_f
from obsloom.functions.text import digits_to_long
from obsloom.operators.ranking import row_id


def stage_obs(
    df: DataFrame,
    *,
    station: str = "station_id",
    time: str = "time",
    time_as: str,
    to_date: bool,
    celsius: dict[str, str],
    rename: dict[str, str],
    key_name: str,
) -> DataFrame:
    """Observations with clear names: ``celsius`` and ``rename`` map raw to staged columns."""
    stamp = F.col(time).cast("date") if to_date else F.col(time)
    return df.select(
        stamp.alias(time_as),
        F.col(station).alias("station_id"),
        *[c_to_f(raw).alias(name) for raw, name in celsius.items()],
        *[F.col(raw).alias(name) for raw, name in rename.items()],
    ).withColumn(key_name, surrogate_key(["station_id", time_as]))


def stage_columns(df: DataFrame, rename: dict[str, str], casts: dict[str, str] | None = None) -> DataFrame:
    """Select and rename columns, casting those in ``casts`` (by raw name)."""
    casts = casts or {}
    return df.select(
        *[(F.col(raw).cast(casts[raw]) if raw in casts else F.col(raw)).alias(name) for raw, name in rename.items()]
    )


def stage_numbered(
    df: DataFrame, *, name: str, name_as: str, amount: str, amount_as: str, id_as: str, tie_break: list[str] = ()
) -> DataFrame:
    """Names with a number written as text cleaned to bigint, and a row id in name order (nulls last)."""
    order = [F.col(c).asc_nulls_last() for c in (name, *tie_break)]
    return row_id(df, order, id_as).select(
        id_as, F.col(name).alias(name_as), digits_to_long(amount).alias(amount_as)
    )
