"""Every date with its neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.functions.keys import surrogate_key
from obsloom.operators.skew import lookup_join

BLOCK_DAYS = 64


def _with_anchors(df: DataFrame, key: str, date: str, n: int, values: Column) -> DataFrame:
    """Rows with ``_anchors``: the dates of their key at most ``n`` days away.

    Keys are cut into blocks of days, so a key's history is spread over tasks. A row near the
    edge of its block is repeated, without its values, in the next one.
    """
    block_days = max(BLOCK_DAYS, 2 * n + 1)
    day = F.unix_date(date)
    own = F.floor(day / block_days)
    blocks = F.array_distinct(F.array(own, F.floor((day - n) / block_days), F.floor((day + n) / block_days)))
    at_home = F.col("_block") == F.col("_own")
    placed = (
        df.dropna(subset=[key, date])
        .select(key, date, day.alias("_day"), own.alias("_own"), F.explode(blocks).alias("_block"), values.alias("_rest"))
        .withColumn("_rest", F.when(at_home, F.col("_rest")))
    )
    near = W.partitionBy(key, "_block").orderBy("_day").rangeBetween(-n, n)
    return placed.withColumn("_anchors", F.collect_set(date).over(near)).filter(at_home).select(key, date, "_anchors", "_rest")


def _keyed(df: DataFrame, key: str, anchor_as: str, date: str, rest: list[str], key_name: str) -> DataFrame:
    return df.select(surrogate_key([key, anchor_as, date]).alias(key_name), key, anchor_as, date, *rest)


def window_expand(
    df: DataFrame,
    *,
    key: str,
    date: str,
    n: int = 2,
    anchor_as: str = "anchor_date",
    key_name: str = "station_obs_window_id",
) -> DataFrame:
    """For each key and date (the anchor), the rows within ``n`` days of it.

    A row belongs to the anchors that are dates of its own key at most ``n`` days away. A window
    over neighbouring dates finds them, so no join is needed: rows are shuffled once and the
    input is read once. Meant for about one row per key and date; see ``window_expand_repeated``.
    """
    rest = [c for c in df.columns if c not in (key, date)]
    values = F.struct(*rest) if rest else F.lit(True)
    anchored = _with_anchors(df, key, date, n, values).select(
        key, F.explode("_anchors").alias(anchor_as), date, *[F.col("_rest")[c].alias(c) for c in rest]
    )
    return _keyed(anchored, key, anchor_as, date, rest, key_name)


def window_expand_repeated(
    df: DataFrame,
    *,
    key: str,
    date: str,
    n: int = 2,
    anchor_as: str = "anchor_date",
    key_name: str = "station_obs_window_id",
) -> DataFrame:
    """The same rows, for inputs that may have very many rows per key and date.

    Neighbours are found between distinct dates and then looked up by the rows, with hot keys
    and dates spread over several tasks.
    """
    rest = [c for c in df.columns if c not in (key, date)]
    dates = _with_anchors(df.select(key, date).distinct(), key, date, n, F.lit(True)).drop("_rest")
    found = lookup_join(df, dates, [key, date], "inner", spread=rest or [date])
    return _keyed(found.withColumn(anchor_as, F.explode("_anchors")), key, anchor_as, date, rest, key_name)
