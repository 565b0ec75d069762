"""Coverage, gaps and the per-station scorecard.

All three come from one pass. Rows are first reduced per key and block of 64 days, on the map
side where possible: sums, bounds, and the reported days as the bits of one long. Runs of missing
days inside a block are read off the bits. The blocks of a key, a few hundred for a long history,
are then put together, where the runs across block ends are added. No date spine is built, no
task holds a key's whole history, and everything stays in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.functions.numeric import guarded_ratio, match_flag, out_of_range

BLOCK_DAYS = 64


@dataclass
class Totals:
    """Sums and maxima to take along in the same pass, as name -> column over the input rows."""

    sums: dict[str, Column] = field(default_factory=dict)
    maxima: dict[str, Column] = field(default_factory=dict)


def _bits(c: Column) -> Column:
    return F.bit_count(c).cast("bigint")


def _run_starts(bits: Column) -> Column:
    """The first bit of every run of ones."""
    return bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))


def _shrunk(df: DataFrame, bits: str, length: int, name: str) -> DataFrame:
    """Add ``name``: the bits from which at least ``length`` ones follow, themselves counted."""
    if length > BLOCK_DAYS:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    df, covered = df.withColumn(name, F.col(bits)), 1
    while covered < length:
        step = min(covered, length - covered)
        df = df.withColumn(name, F.col(name).bitwiseAND(F.shiftrightunsigned(name, step)))
        covered += step
    return df


def series_summary(
    df: DataFrame, *, key: str, date: str, present: Column, min_run: int = 30, totals: Totals | None = None
) -> DataFrame:
    """Per key: first and last date, days reported, days and runs without a value, and ``totals``.

    A day is missing when it has no row or none for which ``present`` holds.
    """
    totals = totals or Totals()
    day = F.unix_date(date)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), day.bitwiseAND(F.lit(BLOCK_DAYS - 1)))
    blocks = df.groupBy(key, F.floor(day / BLOCK_DAYS).alias("_block")).agg(
        F.min(day).alias("_first"),
        F.max(day).alias("_last"),
        F.min(F.when(present, day)).alias("_first_present"),
        F.max(F.when(present, day)).alias("_last_present"),
        F.coalesce(F.bit_or(bit), F.lit(0)).alias("_days"),
        F.bit_or(F.when(present, bit)).alias("_present"),
        *[F.sum(c).alias(n) for n, c in totals.sums.items()],
        *[F.max(c).alias(n) for n, c in totals.maxima.items()],
    )
    # Bits from the first to the last present day of the block that are not set.
    start = (F.col("_block") * BLOCK_DAYS).cast("int")
    from_first = F.expr("shiftleft(-1L, _first_present - _start)")
    to_last = F.expr("shiftrightunsigned(-1L, _start + 63 - _last_present)")
    missing = F.bitwise_not(F.col("_present")).bitwiseAND(from_first).bitwiseAND(to_last)
    blocks = blocks.withColumn("_start", start).withColumn("_missing", F.coalesce(missing, F.lit(0)))
    blocks = _shrunk(blocks, "_missing", min_run, "_long")
    # At most one row per block of days in each of these partitions.
    earlier = W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    linked = blocks.select(
        key,
        "_first",
        "_last",
        "_first_present",
        "_last_present",
        _bits(F.col("_days")).alias("_reported"),
        _bits(F.col("_missing")).alias("_gap_days"),
        _bits(_run_starts(F.col("_missing"))).alias("_runs"),
        (_bits(F.col("_long")) + (min_run - 1) * _bits(_run_starts(F.col("_long")))).alias("_long_days"),
        _bits(_run_starts(F.col("_long"))).alias("_long_runs"),
        (F.col("_first_present") - F.max("_last_present").over(earlier) - 1).cast("bigint").alias("_border"),
        *totals.sums,
        *totals.maxima,
    )

    def border(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("bigint")))

    crosses, crosses_long = F.col("_border") > 0, F.col("_border") >= min_run
    one = F.lit(1).cast("bigint")
    per_key = linked.groupBy(key).agg(
        F.min("_first").alias("_lo"),
        F.max("_last").alias("_hi"),
        F.sum("_reported").alias("total_days"),
        (F.sum("_gap_days") + border(crosses, F.col("_border"))).alias("_inner_days"),
        (F.sum("_runs") + border(crosses, one)).alias("_inner_runs"),
        (F.sum("_long_days") + border(crosses_long, F.col("_border"))).alias("_inner_long"),
        (F.sum("_long_runs") + border(crosses_long, one)).alias("_inner_long_runs"),
        # Without any present day the whole span is one run before it.
        (F.coalesce(F.min("_first_present"), F.max("_last") + 1) - F.min("_first")).cast("bigint").alias("_lead"),
        (F.max("_last") - F.coalesce(F.max("_last_present"), F.max("_last"))).cast("bigint").alias("_trail"),
        *[F.sum(n).alias(n) for n in totals.sums],
        *[F.max(n).alias(n) for n in totals.maxima],
    )

    def edges(threshold: int, days: bool) -> Column:
        """Days or number of the runs at both ends that reach ``threshold``."""
        counted = [F.when(F.col(c) >= threshold, F.col(c) if days else one).otherwise(0) for c in ("_lead", "_trail")]
        return counted[0] + counted[1]

    return per_key.select(
        key,
        F.date_from_unix_date("_lo").alias("first_obs_date"),
        F.date_from_unix_date("_hi").alias("last_obs_date"),
        (F.col("_hi") - F.col("_lo") + 1).cast("bigint").alias("data_span_days"),
        "total_days",
        (F.col("_inner_days") + edges(1, True)).alias("total_gap_days"),
        (F.col("_inner_long") + edges(min_run, True)).alias("long_gap_count"),
        (F.col("_inner_runs") + edges(1, False)).alias("gap_periods"),
        (F.col("_inner_long_runs") + edges(min_run, False)).alias("long_gap_periods"),
        *totals.sums,
        *totals.maxima,
    )


def coverage(df: DataFrame, *, key: str, date: str) -> DataFrame:
    """First and last date, span, distinct days and the share of days reported, per key."""
    summary = series_summary(df, key=key, date=date, present=F.col(date).isNotNull())
    return summary.select(
        key,
        "first_obs_date",
        "last_obs_date",
        "data_span_days",
        "total_days",
        guarded_ratio("total_days", "data_span_days").alias("percent_days_reported"),
    )


def gaps(
    df: DataFrame, *, key: str, date: str, metric: str, min_run: int = 30, keep_gapless: bool = False
) -> DataFrame:
    """Days without a value of ``metric`` between a key's first and last date.

    ``long_gap_count`` counts the days inside runs of at least ``min_run`` days;
    ``long_gap_periods`` counts those runs. Keys without any gap are left out unless asked for.
    """
    summary = series_summary(df, key=key, date=date, present=F.col(metric).isNotNull(), min_run=min_run)
    return _with_gap_columns(summary, keep_gapless).select(
        key, "total_gap_days", "pct_gap_days", "long_gap_count", "long_gap_periods"
    )


def _with_gap_columns(summary: DataFrame, keep_gapless: bool) -> DataFrame:
    kept = summary if keep_gapless else summary.filter("total_gap_days > 0")
    return kept.withColumn("pct_gap_days", guarded_ratio("total_gap_days", "data_span_days"))


@dataclass(frozen=True)
class Scorecard:
    """What the scorecard reports on; ``second`` prefixes the second source's own values."""

    gap_metric: str
    source_metric: str
    matched: tuple[str, ...]
    compared: tuple[str, ...]
    zero_counts: dict[str, str]
    ranged: tuple[str, ...]
    low: float = -90
    high: float = 140
    tolerance: float = 0.05
    second: str = "hs_"
    min_run: int = 30


def qc_summary(
    merged: DataFrame, dim: DataFrame, *, key: str, date: str, card: Scorecard, keep_gapless: bool = False
) -> DataFrame:
    """One row per key of ``dim`` that has observations (and, by default, at least one gap).

    ``merged`` comes from ``merge_sources_qc`` with the second source's values kept.
    """
    source = {m: F.col(f"{m}_source") for m in {card.source_metric, *card.matched}}
    flag = {m: match_flag(f"{m}_diff_pct", card.tolerance) for m in card.matched}

    def ones(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    totals = Totals()
    for label, value in (("both", "both"), ("only_daily", "daily"), ("only_hourly", "hourly")):
        totals.sums[f"days_{label}_{card.source_metric}"] = ones(source[card.source_metric] == value)
    for m in card.matched:
        totals.sums[f"_matched_{m}"] = flag[m].cast("bigint")
        totals.sums[f"_both_{m}"] = ones(source[m] == "both")
        totals.sums[f"x_cnt_{m}"] = ones((source[m] == "both") & (flag[m] == 0))
    for m in card.compared:
        difference = F.col(f"{card.second}{m}") - F.col(m)
        totals.sums[f"_abs_{m}"] = F.abs(difference)
        totals.sums[f"_signed_{m}"] = difference
        totals.sums[f"_compared_{m}"] = ones(difference.isNotNull())
        totals.maxima[f"max_abs_diff_{m}"] = F.abs(difference)
    for name, m in card.zero_counts.items():
        totals.sums[name] = ones(F.coalesce(F.col(m), F.col(f"{card.second}{m}")) == 0)
    for m in card.ranged:
        totals.sums[f"count_out_of_range_{m}"] = ones(out_of_range(m, card.low, card.high))

    summary = series_summary(
        merged, key=key, date=date, present=F.col(card.gap_metric).isNotNull(), min_run=card.min_run, totals=totals
    )
    scored = _with_gap_columns(summary, keep_gapless).withColumn(
        "percent_days_reported", guarded_ratio("total_days", "data_span_days")
    )
    differences = []
    for m in card.compared:
        differences += [guarded_ratio(f"_abs_{m}", f"_compared_{m}").alias(f"avg_abs_diff_{m}"), F.col(f"max_abs_diff_{m}")]
    attributes = [c for c in dim.columns if c != key]
    return scored.join(dim, key).select(
        key,
        *attributes,
        "first_obs_date",
        "last_obs_date",
        "total_days",
        "data_span_days",
        "percent_days_reported",
        "total_gap_days",
        "long_gap_count",
        "pct_gap_days",
        *[f"days_{label}_{card.source_metric}" for label in ("both", "only_daily", "only_hourly")],
        *[guarded_ratio(f"_matched_{m}", f"_both_{m}").alias(f"pct_matched_{m}") for m in card.matched],
        *[f"x_cnt_{m}" for m in card.matched],
        *differences,
        *[guarded_ratio(f"_signed_{m}", f"_compared_{m}").alias(f"avg_diff_{m}") for m in card.compared],
        *card.zero_counts,
        *[f"count_out_of_range_{m}" for m in card.ranged],
    )
