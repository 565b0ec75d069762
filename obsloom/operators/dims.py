"""Calendar and hour dimensions, and dimensions enriched with counts from a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsloom.functions.calendar import date_parts
from obsloom.functions.text import hour_label


def date_dim(facts: DataFrame, date: str, end) -> DataFrame:
    """One row per day from the first ``date`` of ``facts`` up to, not including, ``end``.

    ``end`` is a column or a ``datetime.date``. The first date is a single row, so the calendar
    is spread over tasks by year before its days are made.
    """
    end = end if not hasattr(end, "isoformat") else F.lit(end)
    bounds = facts.agg(F.min(F.col(date).cast("date")).alias("_start")).filter(F.col("_start") < end)
    years = bounds.select(
        "_start", F.explode(F.sequence(F.year("_start"), F.year(F.date_sub(end, 1)))).alias("_y")
    )
    days = years.select(
        F.explode(
            F.sequence(
                F.greatest("_start", F.make_date("_y", F.lit(1), F.lit(1))),
                F.least(F.date_sub(end, 1), F.make_date("_y", F.lit(12), F.lit(31))),
            )
        ).alias("date_key")
    )
    return days.select("date_key", *[c.alias(n) for n, c in date_parts("date_key").items()])


def ten_years_from_today():
    """The calendar's default end: ten years after the current date."""
    return F.add_months(F.current_date(), 120)


def hour_dim(spark: SparkSession, end: int = 24) -> DataFrame:
    """Hours 0 up to, not including, ``end`` with a label."""
    return spark.range(0, end).select(F.col("id").alias("hour"), hour_label("id").alias("hour_label"))


def counts_by_key(facts: DataFrame, key: str, distinct: dict[str, str], present: dict[str, str]) -> DataFrame:
    """Per key: exact distinct values of some columns and non-null rows of others.

    Each distinct count goes over its own two columns: several in one aggregate would copy every fact
    row once per count. Facts without a key count nowhere a dimension could see.
    """
    keyed = facts.where(F.col(key).isNotNull())
    counts = keyed.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0)).alias(name) for name, c in present.items()],
    )
    for name, c in distinct.items():
        values = keyed.where(F.col(c).isNotNull()).select(key, F.col(c).alias("_value")).distinct()
        counts = counts.join(values.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left")
    return counts.select(key, *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in distinct], *present)


def with_counts(dim: DataFrame, facts: DataFrame, key: str, distinct: dict[str, str], present: dict[str, str]) -> DataFrame:
    """A dimension with counts joined on; null where a member has no facts."""
    return dim.join(counts_by_key(facts, key, distinct, present), key, "left")
