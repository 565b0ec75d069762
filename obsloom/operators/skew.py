"""Joins that stay balanced when one key holds a large share of the rows.

A side is broadcast only after its rows and their bytes have been measured. Beyond the limits the join is
shuffled, and the rows of hot keys are spread over several tasks by a salt that is a hash of
the fact rows' own grain, so a task that runs again puts every row in the same place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.session import materialise

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 128 << 20
HOT_ROWS = 2_000_000
NULL_SALTS = 4_096


def at_most(df: DataFrame, rows: int, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has no more than ``rows`` rows, of together at most ``size`` bytes as text.

    No row comes to the driver: each task measures up to one row beyond the limit and stops, and only
    the rows' lengths leave it.
    """
    lengths = df.select(F.octet_length(F.struct("*").cast("string")).cast("bigint").alias("_size")).limit(rows + 1)
    measured = lengths.agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("size")).first()
    return measured["n"] <= rows and (measured["size"] or 0) <= size


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """Fewer than ``most`` keys with more than ``hot_rows`` rows each, and the number of salts each needs.

    Keys are counted once. Where very many are hot, only those with more than their even share of all
    hot rows are named, so what is broadcast does not grow with the table.
    """
    counts = materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows))
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") > max(hot_rows, rows // most)).select(
        *keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")
    )


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]):
    """Null-safe equality of ``keys`` on both sides."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def salted_join(
    fact: DataFrame, other: DataFrame, keys: list[str], how: str, spread: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Equi-join whose hot fact keys are split over salts; ``other`` is repeated for those keys only.

    Rows with a null key match nothing, so they are spread over salts that ``other`` does not have.
    """
    hot = F.broadcast(hot_keys(fact, keys, hot_rows))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    place = F.xxhash64(*spread)
    salted_fact = fact.join(hot, keys, "left").withColumn(
        "_salt",
        F.when(null_key, -1 - F.pmod(place, F.lit(NULL_SALTS)).cast("int")).otherwise(
            F.coalesce(F.pmod(place, F.col("_salts")).cast("int"), F.lit(0))
        ),
    ).drop("_salts")
    salted_other = other.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    ).drop("_salts")
    return salted_fact.join(salted_other, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    other: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    spread: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``fact`` to ``other`` by ``how`` (inner, left, left_semi, left_anti).

    ``spread`` names fact columns that differ between the rows of one key.
    """
    if at_most(other, broadcast_rows):
        return fact.join(F.broadcast(other), keys, how)
    return salted_join(fact, other, keys, how, spread, hot_rows)
