"""Names that tie the general operators to the weather warehouse."""

from __future__ import annotations

from obsloom.operators.coverage import Scorecard
from obsloom.operators.merge import Pair

KEYS = ["station_id", "obs_date"]

# Raw to staged names, per observation table.
DAILY_CELSIUS = {"tavg": "tavg_f", "tmin": "tmin_f", "tmax": "tmax_f"}
HOURLY_CELSIUS = {"temp": "temp_f", "dwpt": "dwpt_f"}
SHARED_NAMES = {
    "prcp": "precipitation_mm",
    "snow": "snow_mm",
    "wdir": "wind_dir_degrees",
    "wspd": "wind_speed_km_h",
    "wpgt": "wind_peak_gust_km_h",
    "pres": "air_pressure_hpa",
    "tsun": "sunshine_minutes",
}
HOURLY_NAMES = {"rhum": "rhum_pct", **SHARED_NAMES, "coco": "weather_condition_code"}

DAY_MEASURES = [
    ("tavg_f", "avg", "temp_f"),
    ("tmin_f", "min", "temp_f"),
    ("tmax_f", "max", "temp_f"),
    ("avg_dwpt_f", "avg", "dwpt_f"),
    ("min_dwpt_f", "min", "dwpt_f"),
    ("max_dwpt_f", "max", "dwpt_f"),
    ("avg_rhum_pct", "avg", "rhum_pct"),
    ("min_rhum_pct", "min", "rhum_pct"),
    ("max_rhum_pct", "max", "rhum_pct"),
    ("avg_air_pressure_hpa", "avg", "air_pressure_hpa"),
    ("avg_wind_dir_degrees", "avg", "wind_dir_degrees"),
    ("avg_wind_speed_km_h", "avg", "wind_speed_km_h"),
    ("max_wind_peak_gust_km_h", "max", "wind_peak_gust_km_h"),
    ("total_precip_mm", "sum", "precipitation_mm"),
    ("total_snow_mm", "sum", "snow_mm"),
    ("total_sunshine_minutes", "sum", "sunshine_minutes"),
]

# Metrics that both sources report: output name, daily column, rolled-up hourly column.
PAIRS = [
    Pair("tavg_f", "tavg_f", "tavg_f"),
    Pair("tmin_f", "tmin_f", "tmin_f"),
    Pair("tmax_f", "tmax_f", "tmax_f"),
    Pair("precipitation_mm", "precipitation_mm", "total_precip_mm"),
    Pair("snow_mm", "snow_mm", "total_snow_mm"),
    Pair("wind_dir_degrees", "wind_dir_degrees", "avg_wind_dir_degrees"),
    Pair("wind_speed_km_h", "wind_speed_km_h", "avg_wind_speed_km_h"),
    Pair("wind_peak_gust_km_h", "wind_peak_gust_km_h", "max_wind_peak_gust_km_h"),
    Pair("air_pressure_hpa", "air_pressure_hpa", "avg_air_pressure_hpa"),
    Pair("sunshine_minutes", "sunshine_minutes", "total_sunshine_minutes"),
]
MERGED = [p.name for p in PAIRS]
DEW_AND_HUMIDITY = [f"{a}_{m}" for m in ("dwpt_f", "rhum_pct") for a in ("avg", "min", "max")]
HOURLY_ONLY = ["avg_air_pressure_hpa", "avg_wind_dir_degrees", "avg_wind_speed_km_h", "max_wind_peak_gust_km_h"]

DAY_COLUMNS = [*MERGED[:3], *DEW_AND_HUMIDITY, *MERGED[3:]]
QC_COLUMNS = [
    *MERGED[:3],
    *DEW_AND_HUMIDITY,
    *HOURLY_ONLY,
    *MERGED[3:],
    *[f"{m}_source" for m in MERGED],
    *[f"{m}_diff_pct" for m in MERGED],
]

# Short names that the fact tables use.
SHORT = {
    "precipitation_mm": "precip_mm",
    "wind_dir_degrees": "wind_dir_deg",
    "wind_speed_km_h": "wind_speed_kmh",
    "wind_peak_gust_km_h": "wind_gust_kmh",
    "air_pressure_hpa": "pressure_hpa",
    "sunshine_minutes": "sunshine_min",
}


def short_names(columns: list[str]) -> dict[str, str]:
    return {c: SHORT.get(c, c) for c in columns}


FACT_COLUMNS = short_names(DAY_COLUMNS)
# The window fact and the archive tables leave out the dew point's extremes.
NARROW_COLUMNS = short_names([c for c in DAY_COLUMNS if c not in ("min_dwpt_f", "max_dwpt_f")])

STATION_NAMES = {
    "id": "station_id",
    "name": "station_name",
    "country": "country_code",
    "region": "region_code",
    "wmo": "wmo_id",
    "icao": "icao_code",
    "latitude": "latitude",
    "longitude": "longitude",
    "elevation": "elevation",
    "timezone": "timezone",
    **{f"{kind}_{edge}": f"{kind}_{edge}_date" for kind in ("hourly", "daily", "monthly") for edge in ("start", "end")},
    "snapshot_time": "snapshot_time",
}
STATION_DATES = [raw for raw, name in STATION_NAMES.items() if name.endswith("_date")]
STATION_ATTRIBUTES = [n for n in STATION_NAMES.values() if n not in ("station_id", "snapshot_time")]
STATION_IDENTITY = STATION_ATTRIBUTES[:9]

CITY_COORD_NAMES = {
    "UACE": "uace",
    "GEOID": "geoid",
    "GEOID_2": "geoid_2",
    "NAME": "city_name",
    "NAME_2": "city_name_alt",
    "AREA_LAND": "area_land_sqm",
    "AREA_WATER": "area_water_sqm",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "last_load_time": "last_load_time",
}
LAST_HOUR = 23  # the published hour table leaves it out

CITY_DIM_NAMES = {
    "city_coord_pop_id": "city_coord_pop_id",
    "uace": "area_code",
    "city_pop_id": "pop_city_id",
    "pop_city_name": "population_city",
    "population_2023": "population",
    "coord_city_name": "coordinate_city",
    "area_land_sqm": "land_area_sqm",
    "area_water_sqm": "water_area_sqm",
    "latitude": "latitude",
    "longitude": "longitude",
    "total_matched_chars": "match_chars",
    "matched_token_count": "match_tokens",
    "total_matched_chars_no_city": "match_chars_no_city",
    "matched_token_count_no_city": "match_tokens_no_city",
}
MATCH_SCORES = ["total_matched_chars", "matched_token_count", "total_matched_chars_no_city", "matched_token_count_no_city"]
BRIDGE_NAMES = {
    "wmo_id": "wmo",
    "icao_code": "icao",
    **{f"{raw}_date": raw for raw in STATION_DATES},
    "snapshot_time": "station_snapshot_time",
    "city_coord_pop_id": "city_dim_id",
    **{n: CITY_DIM_NAMES[n] for n in ("uace", "city_pop_id", "pop_city_name", "population_2023", "coord_city_name", *MATCH_SCORES)},
    "city_area_land_sqm": "land_area_sqm",
    "city_area_water_sqm": "water_area_sqm",
    "station_to_city_proximity_rank": "station_proximity_rank",
    "city_to_station_proximity_rank": "city_proximity_rank",
}
MATCH_MILES = 100

CARD = Scorecard(
    gap_metric="tavg_f",
    source_metric="tavg_f",
    matched=("tavg_f", "tmin_f", "tmax_f", "precipitation_mm"),
    compared=("tavg_f", "tmin_f", "tmax_f"),
    zero_counts={"count_zero_precip_days": "precipitation_mm", "count_no_sunshine_days": "sunshine_minutes"},
    ranged=("tavg_f", "tmin_f", "tmax_f"),
)

SERVE_SMALL = [*MERGED[:3], *DEW_AND_HUMIDITY]
SERVE_ROUNDED = ["precip_mm", "snow_mm"]
SERVE_FLOAT = ["wind_speed_kmh"]
SERVE_UNSIGNED = ["pressure_hpa", "sunshine_min"]
