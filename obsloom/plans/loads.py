"""Load runs: plan, land and log.

Observations are written first and the log second. A run that stops in between is repeated in
full: landing leaves out what is stored, and a station's newest log row counts, so the second run ends in
the same state as one that went through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.operators.incremental import log_rows, plan_incremental, plan_initial, update_bounds
from obsloom.sources.landing import Landing, bounds_as_text

STATIONS, LOG = "land_obs_stations", "land_obs_load_log"
#: When a station was last planned and run, whether or not it delivered; of the same form as the log.
ATTEMPTS = "land_obs_attempt_log"
KINDS = {"land_obs_daily": ("daily", "day"), "land_obs_hourly": ("hourly", "hour")}

# Stations per increment unless a number is given.
INCREMENT_SIZES = {"land_obs_daily": 5, "land_obs_hourly": 3}
USUAL_SIZE = -1


def next_initial(landing: Landing, table: str, *, countries=("US",), states=(), batch_size: int | None = 1) -> DataFrame:
    """The next stations whose history has not been loaded; all with ``batch_size=None``."""
    kind, _ = KINDS[table]
    landing.small(LOG).ensure()
    return plan_initial(
        landing.newest_stations(), landing.source(LOG), table,
        start=f"{kind}_start", end=f"{kind}_end", filters={"country": countries, "region": states}, n=batch_size,
        attempts=landing.source(ATTEMPTS),
    )


def next_incremental(
    landing: Landing, table: str, now: Column, *, countries=("US",), states=(), batch_size: int | None = USUAL_SIZE
) -> DataFrame:
    """The next stations that lack recent observations, with the range to fetch; all with ``batch_size=None``."""
    size = INCREMENT_SIZES[table] if batch_size == USUAL_SIZE else batch_size
    kind, step = KINDS[table]
    return plan_incremental(
        landing.newest_stations(), landing.source(table),
        start=f"{kind}_start", end=f"{kind}_end", step=step, now=now,
        filters={"country": countries, "region": states}, n=size, attempts=landing.source(ATTEMPTS), table=table,
        marks=landing.marks(table),
    )


def land_and_log(
    landing: Landing, batch: DataFrame, table: str, planned: DataFrame, now: Column, log_failures: bool = False
) -> None:
    """Land the delivered rows of the planned stations, then log those stations, and all planned ones as tried.

    Logged are stations that delivered rows; with ``log_failures`` all planned ones, so that a
    station whose delivery failed or was empty is not tried again.
    """
    landing.land(batch, table, now)
    done = planned.select("station_id") if log_failures else batch.select("station_id").distinct().join(
        planned.select("station_id"), "station_id", "left_semi"
    )
    log_loaded(landing, table, done, now)
    log_loaded(landing, table, planned.select("station_id"), now, ATTEMPTS)


def log_loaded(landing: Landing, table: str, stations: DataFrame, now: Column, name: str = LOG) -> None:
    landing.small(name).append(log_rows(stations, table, now))


def land_increment(landing: Landing, batch: DataFrame, table: str, planned: DataFrame, now: Column) -> None:
    """Land an increment. Hourly increments also move the stations' end bound and are logged."""
    landing.land(batch, table, now)
    kind, step = KINDS[table]
    if step == "hour":
        ends = planned.select(F.col("station_id").alias("id"), bounds_as_text("end").alias("new_end"))
        stations = landing.small(STATIONS)
        version = stations.version()
        moved = update_bounds(stations.read(), ends, id_="id", column=f"{kind}_end", spread=["snapshot_time"])
        stations.replace(moved, after=version)
        log_loaded(landing, table, planned.select("station_id"), now)
    log_loaded(landing, table, planned.select("station_id"), now, ATTEMPTS)
