"""The warehouse: staging, intermediate, mart, serve and archive tables as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.functions.keys import surrogate_key
from obsloom.functions.lookups import US_REGIONS, US_STATES, lookup_table
from obsloom.functions.text import nth_part, parts_of
from obsloom.operators import coverage, dims, merge, proximity, reshape, rollup, staging, windows
from obsloom.operators.matching import token_match
from obsloom.operators.skew import lookup_join
from obsloom.operators.snapshot import latest_snapshot, with_label
from obsloom.plans import weather as w
from obsloom.plans.tested import NOT_NULL
from obsloom.session import materialise
from obsloom.sources.published import Build, Published


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


class Warehouse:
    """Every model is a property, computed where its result is used.

    Reading the row ids, the name match or the proximity match for the first time already runs
    jobs, since they fix intermediate values by a checkpoint.

    ``source`` maps a landing table's name to a DataFrame. ``calendar_end`` is the first day
    that the calendar leaves out. ``newest_stations`` gives the newest station snapshot where the store knows it;
    else it is found in the table of all snapshots.
    """

    def __init__(self, source: Callable[[str], DataFrame], calendar_end=None, newest_stations: Callable[[], DataFrame] | None = None):
        self._source, self._newest_stations = source, newest_stations
        self.spark = source("land_obs_stations").sparkSession
        self._calendar_end = dims.ten_years_from_today() if calendar_end is None else calendar_end

    # Staging

    @cached_property
    def stg_obs_daily(self) -> DataFrame:
        return staging.stage_obs(
            self._source("land_obs_daily"), time_as="obs_date", to_date=True,
            celsius=w.DAILY_CELSIUS, rename=w.SHARED_NAMES, key_name="station_date_id",
        )

    @cached_property
    def stg_obs_hourly(self) -> DataFrame:
        return staging.stage_obs(
            self._source("land_obs_hourly"), time_as="obs_time", to_date=False,
            celsius=w.HOURLY_CELSIUS, rename=w.HOURLY_NAMES, key_name="station_time_id",
        )

    @cached_property
    def stg_obs_stations(self) -> DataFrame:
        newest = self._newest_stations() if self._newest_stations else latest_snapshot(self._source("land_obs_stations"), "snapshot_time")
        staged = staging.stage_columns(newest, w.STATION_NAMES, {c: "date" for c in w.STATION_DATES})
        return with_label(staged, "region_code", "region_name", US_REGIONS)

    @cached_property
    def stg_city_coord(self) -> DataFrame:
        return staging.stage_columns(self._source("land_city_coord"), w.CITY_COORD_NAMES)

    @cached_property
    def stg_city_pop(self) -> DataFrame:
        return staging.stage_numbered(
            self._source("land_city_pop"), name="Geographic_Area", name_as="city_name",
            amount="Population_In_2023", amount_as="population_2023", id_as="city_pop_id", tie_break=["Rank"],
        )

    # Intermediate

    @cached_property
    def obs_hourly_day_sum(self) -> DataFrame:
        return rollup.rollup_daily(
            self.stg_obs_hourly, key="station_id", time="obs_time", date_as="obs_date", spec=w.DAY_MEASURES
        )

    @cached_property
    def obs_daily_window(self) -> DataFrame:
        staged = self.stg_obs_daily.drop("station_date_id")
        return windows.window_expand(staged, key="station_id", date="obs_date", n=2)

    @cached_property
    def date_dim(self) -> DataFrame:
        return dims.date_dim(self.stg_obs_daily, "obs_date", self._calendar_end)

    @cached_property
    def city_coord_and_pop(self) -> DataFrame:
        coords, pops = self.stg_city_coord, self.stg_city_pop
        states = lookup_table(
            coords.sparkSession, {name.lower(): code for code, name in US_STATES.items()}, "_state_name", "_state"
        )
        located = pops.join(
            F.broadcast(states), F.lower(nth_part("city_name", ",", -1)) == F.col("_state_name"), "left"
        )
        best = token_match(
            coords, located,
            left_id="uace", left_text="city_name",
            left_regions=parts_of(F.split_part("city_name", F.lit(","), F.lit(2)), "--"),
            right_id="city_pop_id", right_text="city_name", right_region=F.col("_state"),
        )
        names = pops.select("city_pop_id", F.col("city_name").alias("pop_city_name"), "population_2023")
        places = coords.select(
            "uace", F.col("city_name").alias("coord_city_name"),
            "area_land_sqm", "area_water_sqm", "latitude", "longitude",
        )
        named = lookup_join(best, names, ["city_pop_id"], "inner", spread=["uace"])
        return named.join(places, "uace").select(
            surrogate_key(["uace", "city_pop_id"]).alias("city_coord_pop_id"),
            "uace", "city_pop_id", *w.MATCH_SCORES, "pop_city_name", "population_2023", *places.columns[1:],
        )

    @cached_property
    def obs_daily_all(self) -> DataFrame:
        merged = merge.merge_sources(
            self.stg_obs_daily, self.obs_hourly_day_sum, keys=w.KEYS, pairs=w.PAIRS, carry=w.DEW_AND_HUMIDITY
        )
        return merged.select("station_date_id", *w.KEYS, *w.DAY_COLUMNS)

    @cached_property
    def _obs_daily_all_qc(self) -> DataFrame:
        """The merge with provenance, plus the hourly values that the scorecard compares with."""
        return merge.merge_sources_qc(
            self.stg_obs_daily, self.obs_hourly_day_sum, keys=w.KEYS, pairs=w.PAIRS,
            carry=[*w.DEW_AND_HUMIDITY, *w.HOURLY_ONLY], keep_second=w.CARD.second,
        )

    @cached_property
    def obs_daily_all_qc(self) -> DataFrame:
        return self._obs_daily_all_qc.select("station_date_id", *w.KEYS, *w.QC_COLUMNS)

    @cached_property
    def station_city_match(self) -> DataFrame:
        stations = self.stg_obs_stations.drop("region_name").withColumnsRenamed(
            {"latitude": "station_latitude", "longitude": "station_longitude"}
        )
        geography = ["area_land_sqm", "area_water_sqm", "latitude", "longitude"]
        # Both sides are read for the pairs and again for the attributes.
        stations = materialise(stations)
        cities = materialise(_renamed(self.city_coord_and_pop, {c: f"city_{c}" for c in geography}))
        return proximity.proximity_match(
            stations, cities,
            a_id="station_id", a_lat="station_latitude", a_lon="station_longitude",
            b_id="city_coord_pop_id", b_lat="city_latitude", b_lon="city_longitude", miles=w.MATCH_MILES,
        )

    @cached_property
    def obs_daily_all_window(self) -> DataFrame:
        days = self.obs_daily_all.drop("station_date_id")
        return windows.window_expand(days, key="station_id", date="obs_date", n=2)

    @cached_property
    def station_obs_qc(self) -> DataFrame:
        identity = self.stg_obs_stations.select("station_id", *w.STATION_IDENTITY)
        return coverage.qc_summary(self._obs_daily_all_qc, identity, key="station_id", date="obs_date", card=w.CARD)

    # Marts

    @cached_property
    def mart_date_dim(self) -> DataFrame:
        return self.date_dim

    @cached_property
    def mart_hour_dim(self) -> DataFrame:
        return dims.hour_dim(self.stg_obs_daily.sparkSession, w.LAST_HOUR)

    @cached_property
    def mart_obs_fact(self) -> DataFrame:
        return staging.stage_columns(self.obs_daily_all, {**{k: k for k in w.KEYS}, **w.FACT_COLUMNS})

    @cached_property
    def mart_obs_window_fact(self) -> DataFrame:
        keys = ["station_id", "anchor_date", "obs_date"]
        return self.obs_daily_all_window.select(
            F.col("station_obs_window_id").alias("station_anchor_obs_id"),
            surrogate_key(keys).alias("station_anchor_id"),
            *keys,
            *[F.col(c).alias(n) for c, n in w.NARROW_COLUMNS.items()],
        )

    @cached_property
    def mart_stations_dim(self) -> DataFrame:
        counted = dims.with_counts(
            self.stg_obs_stations, self.obs_daily_all, "station_id",
            distinct={
                "distinct_sunshine_minutes_count": "sunshine_minutes",
                "distinct_tmax_f_count": "tmax_f",
            },
            present={"tmax_f_count": "tmax_f"},
        )
        attributes = [*w.STATION_ATTRIBUTES[:3], "region_name", *w.STATION_ATTRIBUTES[3:], "snapshot_time"]
        return counted.select("station_id", *attributes, *counted.columns[-3:])

    @cached_property
    def mart_city_dim(self) -> DataFrame:
        return staging.stage_columns(self.city_coord_and_pop, w.CITY_DIM_NAMES)

    @cached_property
    def mart_city_station_bridge(self) -> DataFrame:
        return _renamed(self.station_city_match, w.BRIDGE_NAMES)

    @cached_property
    def mart_station_obs_qc_obt(self) -> DataFrame:
        measures = [c for c in self.station_obs_qc.columns if c not in ("station_id", *w.STATION_IDENTITY)]
        stations = self.stg_obs_stations.select("station_id", *w.STATION_ATTRIBUTES).withColumnsRenamed(
            {"latitude": "station_latitude", "longitude": "station_longitude"}
        )
        return self.station_obs_qc.select("station_id", *measures).join(stations, "station_id", "left").select(
            *stations.columns, *measures
        )

    # Serve

    @cached_property
    def obs_fact(self) -> DataFrame:
        return reshape.serve_float(self.mart_obs_fact, w.KEYS, list(w.FACT_COLUMNS.values()))

    @cached_property
    def obs_fact_cp(self) -> DataFrame:
        return reshape.serve_compact(
            self.mart_obs_fact, w.KEYS, small=w.SERVE_SMALL, rounded_float=w.SERVE_ROUNDED,
            plain_float=w.SERVE_FLOAT, unsigned=w.SERVE_UNSIGNED,
        )

    # Archive

    @cached_property
    def _narrow(self) -> DataFrame:
        ids = ["station_date_id", *w.KEYS]
        return staging.stage_columns(self.obs_daily_all, {**{k: k for k in ids}, **w.NARROW_COLUMNS})

    @cached_property
    def mart_obs_fact_unpiv(self) -> DataFrame:
        return reshape.unpivot_metrics(self._narrow, ["station_date_id", *w.KEYS], list(w.NARROW_COLUMNS.values()))

    @cached_property
    def mart_station_obs_obt(self) -> DataFrame:
        stations = self.stg_obs_stations.select("station_id", *w.STATION_ATTRIBUTES)
        joined = lookup_join(self._narrow, stations, ["station_id"], "left", spread=["obs_date"])
        return joined.select(
            "station_date_id", "station_id", *w.STATION_ATTRIBUTES, "obs_date", *w.NARROW_COLUMNS.values()
        )


MARTS = (
    "mart_date_dim",
    "mart_hour_dim",
    "mart_obs_fact",
    "mart_obs_window_fact",
    "mart_stations_dim",
    "mart_city_dim",
    "mart_city_station_bridge",
    "mart_station_obs_qc_obt",
)
SERVE = ("obs_fact", "obs_fact_cp")
ARCHIVE = ("mart_obs_fact_unpiv", "mart_station_obs_obt")
WRITERS = 4
MODELS = (
    "stg_obs_daily",
    "stg_obs_hourly",
    "stg_obs_stations",
    "stg_city_coord",
    "stg_city_pop",
    "obs_hourly_day_sum",
    "obs_daily_window",
    "obs_daily_all",
    "obs_daily_all_qc",
    "obs_daily_all_window",
    "station_obs_qc",
    "city_coord_and_pop",
    "station_city_match",
    *MARTS,
    *SERVE,
    *ARCHIVE,
)


#: Tables that are stored by the month of a date.
BY_MONTH = {
    "mart_obs_fact": "obs_date",
    "mart_obs_window_fact": "anchor_date",
    "obs_fact": "obs_date",
    "obs_fact_cp": "obs_date",
    "mart_obs_fact_unpiv": "obs_date",
    "mart_station_obs_obt": "obs_date",
}
#: What several tables are made from, by the name under which it is stored.
SHARED = {
    "stg_obs_stations": "_stations",
    "stg_city_pop": "_city_pop",
    "_obs_daily_all_qc": "_obs_daily_all_qc",
    "city_coord_and_pop": "_city_coord_and_pop",
}


def over(warehouse: Warehouse, merged: DataFrame | None = None, **stored: DataFrame) -> Warehouse:
    """The same warehouse with some models read from what is stored; ``merged`` is the merge with provenance."""
    out = Warehouse(warehouse._source, warehouse._calendar_end, warehouse._newest_stations)
    if merged is not None:
        # The plain merge is a selection from the one with provenance.
        stored |= {"_obs_daily_all_qc": merged, "obs_daily_all": merged.select("station_date_id", *w.KEYS, *w.DAY_COLUMNS)}
    for model, df in stored.items():
        setattr(out, model, df)
    return out


def store_shared(build: Build, warehouse: Warehouse, models, months=None) -> None:
    """Store some of ``SHARED``; the merge by month, and only ``months`` of it if given."""
    for model in models:
        by_month = {"date": "obs_date", "months": months, "order": w.KEYS} if model == "_obs_daily_all_qc" else {}
        build.store(getattr(warehouse, model), SHARED[model], **by_month)


def stored_warehouse(build: Build, warehouse: Warehouse, months=None) -> Warehouse:
    """The warehouse over the stored shared tables; of the merge, some months only if given."""
    shared = {model: build.read(name) for model, name in SHARED.items() if model != "_obs_daily_all_qc"}
    return over(warehouse, build.read(SHARED["_obs_daily_all_qc"], months), **shared)


def store_all(build: Build, frames: dict[str, DataFrame], months: dict[str, set[str]] | None = None) -> None:
    """Store tables, a few at a time so that small ones do not leave the cluster idle."""

    def store(name: str) -> None:
        date = BY_MONTH.get(name)
        build.store(frames[name], name, date, (months or {}).get(name), ["station_id", date] if date else [], NOT_NULL.get(name, ()))

    with ThreadPoolExecutor(WRITERS) as writers:
        list(writers.map(store, frames))


def build_all(warehouse: Warehouse, directory: str, names=(*MARTS, *SERVE, *ARCHIVE), inputs: dict | None = None) -> Published:
    """Build the stored tables and publish them together; readers see the version before until then.

    What several tables share is stored first and read back, so the rollup, the merge, the name
    match and the station snapshot are computed once. Large tables are stored by month and sorted by
    station and date, so filters on date skip files and those on station row groups. ``inputs`` says what was read.
    """
    published = Published(warehouse.spark, directory)
    build = published.build()
    store_shared(build, warehouse, ["stg_obs_stations", "stg_city_pop", "_obs_daily_all_qc"])
    store_shared(build, over(warehouse, stg_city_pop=build.read("_city_pop")), ["city_coord_and_pop"])
    models = stored_warehouse(build, warehouse)
    store_all(build, {name: getattr(models, name) for name in names})
    build.commit(inputs)
    return published
