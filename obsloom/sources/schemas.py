"""Explicit schemas of the landing tables. Ids stay text, so leading zeros survive."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
}

_COLUMNS = {
    "land_obs_daily": (
        "time timestamp_ntz, tavg double, tmin double, tmax double, prcp double, snow double, wdir double, "
        "wspd double, wpgt double, pres double, tsun double, station_id string, load_time string"
    ),
    "land_obs_hourly": (
        "time timestamp_ntz, temp double, dwpt double, rhum double, prcp double, snow double, wdir double, "
        "wspd double, wpgt double, pres double, tsun double, coco double, station_id string, load_time string"
    ),
    "land_obs_stations": (
        "id string, name string, country string, region string, wmo string, icao string, latitude double, "
        "longitude double, elevation double, timezone string, hourly_start string, hourly_end string, "
        "daily_start string, daily_end string, monthly_start string, monthly_end string, snapshot_time string"
    ),
    "land_city_coord": (
        "UACE string, GEOID string, GEOID_2 string, NAME string, NAME_2 string, AREA_LAND bigint, "
        "AREA_WATER bigint, LATITUDE double, LONGITUDE double, last_load_time string"
    ),
    "land_city_pop": "Rank int, Geographic_Area string, Population_In_2023 string, last_load_time string",
    "land_obs_load_log": "station_id string, last_fetched timestamp_ntz, table_name string",
    "land_obs_high_water": "station_id string, last_time timestamp_ntz, table_name string",
    "land_obs_attempt_log": "station_id string, last_fetched timestamp_ntz, table_name string",
}


def _schema(columns: str) -> StructType:
    pairs = (column.split() for column in columns.split(", "))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


LANDING = {name: _schema(columns) for name, columns in _COLUMNS.items()}
#: Records that could not be read, by file and text.
MALFORMED = _schema("file string, record string, times bigint")


def without(schema: StructType, *columns: str) -> StructType:
    """A schema less some columns, such as those added while landing."""
    return StructType([f for f in schema if f.name not in columns])
