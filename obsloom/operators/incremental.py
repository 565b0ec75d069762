"""Incremental loading: what to load next, what is new in a batch, and the load log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.functions.calendar import iso_timestamp
from obsloom.operators.ranking import first_per_key
from obsloom.operators.skew import lookup_join, same_keys

_STEPS = {"day": "INTERVAL 1 DAY", "hour": "INTERVAL 1 HOUR"}


def filter_in(df: DataFrame, column: str, values) -> DataFrame:
    """Keep rows whose ``column`` is listed; an empty list keeps all."""
    return df.filter(F.col(column).isin(list(values))) if values else df


def in_columns(value, columns) -> Column:
    """Whether a value equals that of any of the columns."""
    return (F.col(value) if isinstance(value, str) else value).isin(*[F.col(c) for c in columns])


def first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def _candidates(stations: DataFrame, id_: str, start: str, end: str, filters: dict) -> DataFrame:
    kept = stations.dropna(subset=[start, end])
    for column, values in (filters or {}).items():
        kept = filter_in(kept, column, values)
    return kept.select(F.col(id_).alias("station_id"), F.col(start).alias("_start"), F.col(end).alias("_end"))


def plan_initial(
    stations: DataFrame,
    log: DataFrame,
    table: str,
    *,
    id_: str = "id",
    start: str,
    end: str,
    filters: dict | None = None,
    n: int | None = 1,
    attempts: DataFrame | None = None,
) -> DataFrame:
    """Stations with both bounds that pass the filters and that ``log`` does not list for ``table``.

    With ``attempts`` (a log as well), those never tried come first and then the longest untried, so
    a station that delivers nothing does not keep the others waiting.
    """
    logged = log.filter(F.col("table_name") == table).select("station_id").distinct()
    pending = (
        _candidates(stations, id_, start, end, filters)
        .distinct()
        .join(logged, "station_id", "left_anti")
        .select("station_id", F.col("_start").alias("start"), F.col("_end").alias("end"))
    )
    return _next(pending, n, attempts, table)


def _next(pending: DataFrame, n: int | None, attempts: DataFrame | None, table: str | None) -> DataFrame:
    order = ["station_id", "start", "end"]
    if n is None:
        return pending
    if attempts is None:
        return first_n(pending, n, order)
    tried = attempts.filter(F.col("table_name") == table).groupBy("station_id").agg(F.max("last_fetched").alias("_tried"))
    ordered = pending.join(tried, "station_id", "left")
    return first_n(ordered, n, [F.col("_tried").asc_nulls_first(), *order]).select(*pending.columns)


def high_water(facts: DataFrame, key: str, time: str) -> DataFrame:
    """Latest time per key."""
    return facts.groupBy(F.col(key).alias("station_id")).agg(F.max(time).alias("last_time"))


def plan_incremental(
    stations: DataFrame,
    facts: DataFrame | None,
    *,
    id_: str = "id",
    start: str,
    end: str,
    key: str = "station_id",
    time: str = "time",
    step: str,
    now: Column,
    filters: dict | None = None,
    n: int | None = 5,
    attempts: DataFrame | None = None,
    table: str | None = None,
    marks: DataFrame | None = None,
) -> DataFrame:
    """The time range each station still lacks; ``attempts`` orders as in :func:`plan_initial`.

    ``marks`` (station_id, last_time) take the place of reading the latest times from ``facts``.

    From one ``step`` after its latest fact (or its own start, if it has none) to its own end or
    ``now``, whichever is earlier. Empty ranges are left out: by day with step ``day``.
    """
    ranges = (
        _candidates(stations, id_, start, end, filters)
        .distinct()
        .join(high_water(facts, key, time) if marks is None else marks, "station_id", "left")
        .select(
            "station_id",
            F.coalesce(
                F.col("last_time").cast("timestamp_ntz") + F.expr(_STEPS[step]), iso_timestamp("_start")
            ).alias("start"),
            F.least(iso_timestamp("_end"), now.cast("timestamp_ntz")).alias("end"),
        )
    )
    unit = "date" if step == "day" else "timestamp_ntz"
    pending = ranges.filter(F.col("start").cast(unit) <= F.col("end").cast(unit))
    return _next(pending, n, attempts, table)


def stamp(df: DataFrame, load_time: Column, station: Column | None = None) -> DataFrame:
    """Add where a batch came from and when, as ISO text."""
    stamped = df if station is None else df.withColumn("station_id", station)
    text = F.date_format(load_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return stamped.withColumn("load_time", F.concat(text, F.lit("+00:00")))


def new_rows(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch whose keys are not stored yet, one per key; null keys are equal to each other.

    Of several rows of a key the greatest stays, by the batch's columns in their order, so that a
    repeated run stores the same row.
    """
    kept = existing.select(*keys)
    fresh = batch.join(kept, same_keys(batch, kept, keys), "left_anti")
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return fresh.distinct()
    return first_per_key(fresh, keys, [F.col(f"`{c}`").desc_nulls_last() for c in rest]).select(*batch.columns)


def log_rows(ids: DataFrame, table: str, ts: Column) -> DataFrame:
    """A fresh log row for every station of ``ids``."""
    return ids.select("station_id").distinct().select(
        "station_id", ts.cast("timestamp_ntz").alias("last_fetched"), F.lit(table).alias("table_name")
    )


def upsert_log(log: DataFrame, ids: DataFrame, table: str, ts: Column) -> DataFrame:
    """The log with one fresh row per station of ``ids`` for ``table``, older ones removed."""
    fresh = log_rows(ids, table, ts)
    kept = log.join(fresh.select("station_id", "table_name"), ["station_id", "table_name"], "left_anti")
    return kept.select("station_id", "last_fetched", "table_name").unionByName(fresh)


def update_bounds(
    stations: DataFrame, ends: DataFrame, *, id_: str, column: str, spread: list[str]
) -> DataFrame:
    """Set ``column`` on every row of the stations in ``ends`` (one row per station: id, ``new_end``)."""
    changed = lookup_join(stations, ends.select(id_, "new_end"), [id_], "left", spread=spread)
    return changed.withColumn(column, F.coalesce("new_end", column)).select(*stations.columns)
