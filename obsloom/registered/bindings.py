"""Landing tables derived from the driver's tables.

Each is one SELECT that Spark and the checking engine both read, so that the warehouse and its
SQL counterparts start from the same rows. The odd divisors keep averages off the exact halves
where rounding a sum taken in another order could go either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsloom.registered.common import table
from obsloom.sources.files import aligned
from obsloom.sources.schemas import LANDING

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"
_ZERO = "CAST(0 AS DOUBLE)"
_LOADED = "'2024-02-01T00:00:00+00:00'"


def _select(columns: dict[str, str], tail: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + " FROM " + tail


def _pick(words: str, index: str) -> str:
    return f"split_part('{words}', ',', CAST({index} + 1 AS INT))"


_HOURLY = _select(
    {
        "time": "ts",
        "temp": "value / 7.0013e0 - 5",
        "dwpt": f"{_K} / 4.0007e0 - 10",
        "rhum": f"CAST({_K} AS DOUBLE)",
        "prcp": f"CASE WHEN event_type = 'view' THEN value / 16.0013e0 ELSE {_ZERO} END",
        "snow": f"CAST(nullif({_K} % 3, 0) AS DOUBLE)",
        "wdir": f"CAST(({_K} * 37) % 360 AS DOUBLE)",
        "wspd": "value / 4.0003e0",
        "wpgt": "value / 2",
        "pres": f"1000 + {_K} / 8.0009e0",
        "tsun": f"CASE WHEN event_type <> 'error' THEN CAST({_K} % 60 AS DOUBLE) END",
        "coco": f"CAST({_K} % 27 AS DOUBLE)",
        "station_id": "CAST(user_id AS STRING)",
        "load_time": _LOADED,
    },
    "events",
)

_DAILY = _select(
    {
        "time": "CAST(ts AS DATE) + 2",
        "tavg": "avg(value) / 7.0013e0 - 5",
        "tmin": "min(value) / 7.0013e0 - 5",
        "tmax": "CASE WHEN max(value) <= 60 THEN max(value) / 7.0013e0 - 5 END",
        "prcp": f"sum(CASE WHEN event_type = 'view' THEN value / 16.0013e0 ELSE {_ZERO} END)",
        "snow": f"CAST(max({_K}) % 3 AS DOUBLE)",
        "wdir": f"CAST((min({_K}) * 37) % 360 AS DOUBLE)",
        "wspd": "avg(value) / 4.0003e0",
        "wpgt": "max(value) / 2",
        "pres": f"1000 + min({_K}) / 8.0009e0",
        "tsun": f"CASE WHEN count(*) <= 2 THEN CAST(max({_K}) % 60 AS DOUBLE) END",
        "station_id": "CAST(user_id AS STRING)",
        "load_time": _LOADED,
    },
    "events GROUP BY user_id, CAST(ts AS DATE)",
)


def _day_text(index: str) -> str:
    return f"concat('2024-01-', lpad(CAST({index} % 28 + 1 AS STRING), 2, '0'), 'T00:00:00.000Z')"


def _stations(snapshot: str, source: str) -> str:
    return _select(
        {
            "id": "CAST(c_custkey AS STRING)",
            "name": "c_name",
            "country": "CASE WHEN c_nationkey % 3 = 0 THEN 'CA' ELSE 'US' END",
            "region": f"nullif({_pick('NY,CA,TX,WA,PR,XX,FL,OH,none', 'c_custkey % 9')}, 'none')",
            "wmo": "lpad(CAST(c_custkey % 99999 AS STRING), 5, '0')",
            "icao": "concat('K', lpad(CAST(c_nationkey AS STRING), 3, '0'))",
            "latitude": "25 + (c_custkey * 7919 % 2400) / 100",
            "longitude": "-125 + (c_custkey * 104729 % 5800) / 100",
            "elevation": "c_acctbal",
            "timezone": "'America/New_York'",
            "hourly_start": "'2024-01-01T00:00:00.000Z'",
            "hourly_end": f"CASE WHEN c_custkey % 5 > 0 THEN {_day_text('c_custkey')} END",
            "daily_start": _day_text("c_custkey % 3"),
            "daily_end": f"CASE WHEN c_custkey % 7 > 0 THEN {_day_text('c_custkey * 3')} END",
            "monthly_start": "'2023-01-01T00:00:00.000Z'",
            "monthly_end": "'2023-12-01T00:00:00.000Z'",
            "snapshot_time": f"'{snapshot}'",
        },
        source,
    )


# Two snapshots; the newer one no longer has the customers in debt.
_STATIONS = (
    _stations("2024-02-01T00:00:00+00:00", "customer")
    + " UNION ALL "
    + _stations("2024-03-01T00:00:00+00:00", "customer WHERE c_acctbal >= 0")
)

_WORDS = "Red,Blue,Small,Large,Green,Hot,Cold,Steel"
_THINGS = "Ring,Bolt,Widget,Gear,Pipe,Valve,Panel,Nut"
_CODES = "NY,NJ,CA,TX,WA,FL,OH,DC"
_COORD = _select(
    {
        "UACE": "lpad(CAST(s_suppkey AS STRING), 7, '0')",
        "GEOID": "CAST(s_suppkey AS STRING)",
        "GEOID_2": "concat('4', CAST(s_suppkey AS STRING))",
        "NAME": (
            f"concat({_pick(_WORDS, 's_suppkey % 8')}, ' ', {_pick(_THINGS, 's_nationkey % 8')}, '--', "
            f"{_pick(_WORDS, 's_suppkey * 3 % 8')}, ', ', {_pick(_CODES, 's_suppkey % 7')}, "
            f"CASE WHEN s_suppkey % 3 = 0 THEN concat('--', {_pick(_CODES, 's_suppkey * 5 % 8')}) ELSE '' END)"
        ),
        "NAME_2": "s_name",
        "AREA_LAND": "s_suppkey * 1000",
        "AREA_WATER": "s_suppkey * 10",
        "LATITUDE": "25 + (s_suppkey * 6151 % 2400) / 100",
        "LONGITUDE": "-125 + (s_suppkey * 15485 % 5800) / 100",
        "last_load_time": _LOADED,
    },
    "supplier",
)

_POP = _select(
    {
        "Rank": "CAST(p_partkey + 1 AS INT)",
        "Geographic_Area": (
            "concat(p_name, ' city, ', "
            + _pick("New York,New Jersey,California,Texas,Washington,Florida,District of Columbia,Ohio", "p_partkey % 8")
            + ")"
        ),
        "Population_In_2023": (
            "concat(CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), ',', lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'))"
        ),
        "last_load_time": _LOADED,
    },
    "part",
)

LANDING_SQL = {
    "land_obs_daily": _DAILY,
    "land_obs_hourly": _HOURLY,
    "land_obs_stations": _STATIONS,
    "land_city_coord": _COORD,
    "land_city_pop": _POP,
}


def landing_source(spark: SparkSession, sf_dir: str, **instead: DataFrame):
    """A landing reader over the driver's tables, some of them replaced by others."""
    tables = {t: instead[t] if t in instead else table(spark, sf_dir, t) for t in ("events", "customer", "supplier", "part")}

    def source(name: str) -> DataFrame:
        text = LANDING_SQL[name]
        used = {t: df for t, df in tables.items() if f" {t}" in text}
        for t in used:
            text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
        return aligned(spark.sql(text, **used), LANDING[name])

    return source
