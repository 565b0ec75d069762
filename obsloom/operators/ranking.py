"""Row numbers over a whole table and within keys, and the best row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.operators.skew import same_keys
from obsloom.session import materialise

GROUP_ROWS = 5_000_000
_POSITION_BITS = (1 << 33) - 1


def row_id(df: DataFrame, order: list[Column], name: str = "row_id") -> DataFrame:
    """Number all rows 1..n in ``order`` (which must have no ties) without a single-task window.

    The sort is range partitioned. Each row's place inside its partition is written down with
    the rows by a checkpoint, and the partitions' sizes, one row each, give the offsets.
    """
    placed = materialise(
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_place") + 1).alias(name), *df.columns
    )


def rank_within(
    df: DataFrame, keys: list[str], order: list[Column], name: str, group_rows: int = GROUP_ROWS, largest: int | None = None
) -> DataFrame:
    """Row number per key in ``order`` (which must have no ties within a key).

    The largest group is measured first, if ``largest`` does not tell its rows. While it fits one task a plain window is used. Beyond
    that, rows are range partitioned on key and order, which cuts a large key over many
    partitions, and numbered inside each piece.
    """
    if largest is None:
        largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if largest is None or largest <= group_rows:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    return _rank_in_pieces(df, keys, order, name)


def _rank_in_pieces(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    pieces = materialise(
        df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id())
    )
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # Only the first key of a partition can continue from the one before, so this has at most
    # one row per partition.
    offsets = (
        pieces.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .filter("_before > 0")
        .drop("_n")
    )
    numbered = pieces.withColumn(
        "_in_piece", F.row_number().over(W.partitionBy(*keys, "_part").orderBy(*order))
    )
    joined = numbered.join(F.broadcast(offsets), same_keys(numbered, offsets, [*keys, "_part"]), "left")
    return joined.select(
        *[numbered[c] for c in df.columns],
        (numbered["_in_piece"] + F.coalesce(offsets["_before"], F.lit(0))).cast("bigint").alias(name),
    )


def best_per_key(
    df: DataFrame, keys: list[str], largest: list[str], then_smallest: list[str], carry: list[str] = ()
) -> DataFrame:
    """One row per key: greatest ``largest`` columns, then least ``then_smallest``, then least ``carry``.

    A rank that Spark cuts off before the shuffle as well (a window group limit), so each task
    passes on one row per key, however many it holds. Nulls come first in either direction.
    """
    order = [F.col(c).desc_nulls_first() for c in largest]
    order += [F.col(c).asc_nulls_first() for c in (*then_smallest, *carry)]
    return first_per_key(df, keys, order).select(*keys, *then_smallest, *largest, *carry)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; null keys are equal to each other."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
