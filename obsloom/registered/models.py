"""The warehouse's models over the derived landing tables."""

from __future__ import annotations

import datetime as dt

from obsloom.functions.lookups import US_REGIONS, US_STATES
from obsloom.plans import weather as w
from obsloom.plans.warehouse import MODELS, Warehouse
from obsloom.registered.bindings import LANDING_SQL, landing_source
from obsloom.registered.common import (
    Registry,
    labelled,
    rounded,
    sql_gaps,
    sql_haversine,
    sql_key,
    sql_ratio,
    sql_rounded,
    sql_select,
)

CALENDAR_END = dt.date(2026, 1, 1)
_F = "{0} * 9.0 / 5.0 + 32.0 AS {1}"
_STATION_COLUMNS = [*w.STATION_NAMES.values()]
_DIFFS = [f"{m}_diff_pct" for m in w.MERGED]
_STATION_POINT = {"latitude": "station_latitude", "longitude": "station_longitude"}


def _pairs(mapping: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())


def _staged(celsius: dict[str, str], names: dict[str, str]) -> str:
    return ", ".join([*[_F.format(a, b) for a, b in celsius.items()], *[f"{a} AS {b}" for a, b in names.items()]])


def _source_flag(p) -> str:
    return (
        f"CASE WHEN d.station_id IS NULL AND h.station_id IS NOT NULL THEN 'hourly' "
        f"WHEN d.{p.first} IS NOT NULL AND h.{p.second} IS NOT NULL THEN 'both' "
        f"WHEN d.{p.first} IS NOT NULL THEN 'daily' WHEN h.{p.second} IS NOT NULL THEN 'hourly' END AS {p.name}_source"
    )


def _merged() -> str:
    values = [f"coalesce(d.{p.first}, h.{p.second}) AS {p.name}" for p in w.PAIRS]
    flags = [_source_flag(p) for p in w.PAIRS]
    diffs = [f"(h.{p.second} - d.{p.first}) / d.{p.first} AS {p.name}_diff_pct" for p in w.PAIRS]
    second = [f"h.{p.second} AS hs_{p.name}" for p in w.PAIRS]
    carried = [f"h.{c} AS {c}" for c in (*w.DEW_AND_HUMIDITY, *w.HOURLY_ONLY)]
    return (
        f"SELECT {sql_key('station_id', 'obs_date')} AS station_date_id, * FROM (SELECT "
        "coalesce(d.station_id, h.station_id) AS station_id, coalesce(d.obs_date, h.obs_date) AS obs_date, "
        + ", ".join([*values, *carried, *flags, *diffs, *second])
        + " FROM stg_obs_daily d FULL JOIN obs_hourly_day_sum h ON d.station_id = h.station_id AND d.obs_date = h.obs_date)"
    )


def _window(source: str, columns: list[str]) -> str:
    return (
        f"SELECT {sql_key('a.station_id', 'a.anchor_date', 'o.obs_date')} AS station_obs_window_id, "
        f"a.station_id, a.anchor_date, o.obs_date, {', '.join('o.' + c for c in columns)} "
        f"FROM (SELECT DISTINCT station_id, obs_date AS anchor_date FROM {source}) a JOIN {source} o "
        "ON o.station_id = a.station_id AND abs(date_diff('day', a.anchor_date, o.obs_date)) <= 2"
    )


def _scorecard() -> str:
    card = w.CARD

    def match(m: str) -> str:
        return f"CASE WHEN abs({m}_diff_pct) >= 0.05 THEN 0 ELSE 1 END"

    def total(condition: str) -> str:
        return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"

    m0 = card.source_metric
    sums = [f"{total(f'{m0}_source = {v!r}')} AS days_{label}_{m0}" for label, v in (("both", "both"), ("only_daily", "daily"), ("only_hourly", "hourly"))]
    sums += [
        f"{sql_ratio(f'sum({match(m)})', total(f'{m}_source = {chr(39)}both{chr(39)}'))} AS pct_matched_{m}" for m in card.matched
    ]
    sums += [f"{total(f'{m}_source = {chr(39)}both{chr(39)} AND {match(m)} = 0')} AS x_cnt_{m}" for m in card.matched]
    for m in card.compared:
        sums += [f"avg(abs({m} - hs_{m})) AS avg_abs_diff_{m}", f"max(abs({m} - hs_{m})) AS max_abs_diff_{m}"]
    sums += [f"avg(hs_{m} - {m}) AS avg_diff_{m}" for m in card.compared]
    sums += [f"{total(f'coalesce({m}, hs_{m}) = 0')} AS {n}" for n, m in card.zero_counts.items()]
    sums += [f"{total(f'{m} < -90 OR {m} > 140')} AS count_out_of_range_{m}" for m in card.ranged]
    return f"SELECT station_id, {', '.join(sums)} FROM obs_daily_all_qc GROUP BY station_id"


_QC_MEASURES = [
    "first_obs_date", "last_obs_date", "total_days", "data_span_days", "percent_days_reported",
    "total_gap_days", "long_gap_count", "pct_gap_days",
    "days_both_tavg_f", "days_only_daily_tavg_f", "days_only_hourly_tavg_f",
    *[f"pct_matched_{m}" for m in w.CARD.matched],
    *[f"x_cnt_{m}" for m in w.CARD.matched],
    *[f"{a}_abs_diff_{m}" for m in w.CARD.compared for a in ("avg", "max")],
    *[f"avg_diff_{m}" for m in w.CARD.compared],
    *w.CARD.zero_counts,
    *[f"count_out_of_range_{m}" for m in w.CARD.ranged],
]
_QC_DOUBLES = [m for m in _QC_MEASURES if m.startswith(("p", "avg", "max"))] + ["latitude", "longitude", "elevation"]
_QC_COLUMNS = ["station_id", *w.STATION_IDENTITY, *_QC_MEASURES]
_CITY_COLUMNS = [*w.CITY_DIM_NAMES]
_CITY_IN_MATCH = [
    {"area_land_sqm": "city_area_land_sqm", "area_water_sqm": "city_area_water_sqm", "latitude": "city_latitude", "longitude": "city_longitude"}.get(c, c)
    for c in ("city_coord_pop_id", "uace", "city_pop_id", *w.MATCH_SCORES, "pop_city_name", "population_2023", "coord_city_name", "area_land_sqm", "area_water_sqm", "latitude", "longitude")
]
_MATCH_COLUMNS = [
    "station_city_match_id",
    *[_STATION_POINT.get(c, c) for c in _STATION_COLUMNS],
    *_CITY_IN_MATCH,
    "distance_miles",
    "station_to_city_proximity_rank",
    "city_to_station_proximity_rank",
]
_GEO = ["latitude", "longitude", "elevation", "station_latitude", "station_longitude", "city_latitude", "city_longitude", "distance_miles"]

_CTES = {
    **LANDING_SQL,
    "stg_obs_daily": (
        f"SELECT *, {sql_key('station_id', 'obs_date')} AS station_date_id FROM (SELECT CAST(time AS DATE) AS obs_date, "
        f"station_id, {_staged(w.DAILY_CELSIUS, w.SHARED_NAMES)} FROM land_obs_daily)"
    ),
    "stg_obs_hourly": (
        f"SELECT *, {sql_key('station_id', 'obs_time')} AS station_time_id FROM (SELECT time AS obs_time, "
        f"station_id, {_staged(w.HOURLY_CELSIUS, w.HOURLY_NAMES)} FROM land_obs_hourly)"
    ),
    "stg_obs_stations": (
        "SELECT "
        + ", ".join((f"CAST({a} AS DATE) AS {b}" if a in w.STATION_DATES else f"{a} AS {b}") for a, b in w.STATION_NAMES.items())
        + f", r.region_name FROM land_obs_stations LEFT JOIN (VALUES {_pairs(US_REGIONS)}) r(code, region_name) ON r.code = region "
        "WHERE snapshot_time = (SELECT max(snapshot_time) FROM land_obs_stations)"
    ),
    "stg_city_coord": "SELECT " + ", ".join(f"{a} AS {b}" for a, b in w.CITY_COORD_NAMES.items()) + " FROM land_city_coord",
    "stg_city_pop": (
        "SELECT row_number() OVER (ORDER BY Geographic_Area, Rank) AS city_pop_id, Geographic_Area AS city_name, "
        "CAST(regexp_replace(Population_In_2023, '[^0-9]+', '', 'g') AS BIGINT) AS population_2023 FROM land_city_pop"
    ),
    "obs_hourly_day_sum": (
        f"SELECT {sql_key('station_id', 'obs_date')} AS station_date_id, * FROM (SELECT station_id, CAST(obs_time AS DATE) AS obs_date, "
        + ", ".join(f"{f}({c}) AS {o}" for o, f, c in w.DAY_MEASURES)
        + " FROM stg_obs_hourly GROUP BY ALL)"
    ),
    "obs_daily_window": _window("stg_obs_daily", [*w.DAILY_CELSIUS.values(), *w.SHARED_NAMES.values()]),
    "obs_daily_all_qc": _merged(),
    "obs_daily_all": f"SELECT station_date_id, station_id, obs_date, {', '.join(w.DAY_COLUMNS)} FROM obs_daily_all_qc",
    "obs_daily_all_window": _window("obs_daily_all", w.DAY_COLUMNS),
    "coords": (
        "SELECT *, list_distinct(list_transform("
        "string_split(split_part(city_name, ',', 2), '--'), lambda x: trim(x))) AS states FROM stg_city_coord"
    ),
    "pops": (
        f"SELECT p.*, s.code AS state FROM stg_city_pop p LEFT JOIN (VALUES {_pairs(US_STATES)}) s(code, full_name) "
        "ON lower(s.full_name) = lower(trim(split_part(p.city_name, ',', -1)))"
    ),
    "shared_words": (
        "SELECT c.uace, p.city_pop_id, c.word FROM "
        "(SELECT uace, states, unnest(regexp_split_to_array(lower(city_name), '[^a-z0-9]+')) AS word FROM coords) c JOIN "
        "(SELECT city_pop_id, state, unnest(regexp_split_to_array(lower(city_name), '[^a-z0-9]+')) AS word FROM pops) p "
        "ON c.word = p.word AND list_contains(c.states, p.state) WHERE c.word <> ''"
    ),
    "city_coord_and_pop": (
        f"SELECT {sql_key('uace', 'city_pop_id')} AS city_coord_pop_id, uace, city_pop_id, {', '.join(w.MATCH_SCORES)}, "
        "p.city_name AS pop_city_name, p.population_2023, c.city_name AS coord_city_name, "
        "c.area_land_sqm, c.area_water_sqm, c.latitude, c.longitude FROM ("
        "SELECT uace, city_pop_id, CAST(sum(length(word)) AS BIGINT) AS total_matched_chars, count(*) AS matched_token_count, "
        "CAST(coalesce(sum(length(word)) FILTER (WHERE word <> 'city'), 0) AS BIGINT) AS total_matched_chars_no_city, "
        "count(*) FILTER (WHERE word <> 'city') AS matched_token_count_no_city FROM shared_words GROUP BY uace, city_pop_id "
        "QUALIFY row_number() OVER (PARTITION BY uace ORDER BY total_matched_chars DESC, matched_token_count DESC, city_pop_id) = 1"
        ") JOIN pops p USING (city_pop_id) JOIN coords c USING (uace)"
    ),
    "near": (
        "SELECT * FROM (SELECT s.* EXCLUDE (latitude, longitude, region_name), s.latitude AS station_latitude, s.longitude AS station_longitude, "
        "c.* EXCLUDE (area_land_sqm, area_water_sqm, latitude, longitude), c.area_land_sqm AS city_area_land_sqm, "
        "c.area_water_sqm AS city_area_water_sqm, c.latitude AS city_latitude, c.longitude AS city_longitude, "
        f"{sql_haversine('s.latitude', 's.longitude', 'c.latitude', 'c.longitude')} AS distance_miles "
        "FROM stg_obs_stations s, city_coord_and_pop c) WHERE distance_miles <= 100"
    ),
    "station_city_match": (
        f"SELECT *, {sql_key('station_id', 'city_coord_pop_id')} AS station_city_match_id, "
        "row_number() OVER (PARTITION BY station_id ORDER BY distance_miles, city_coord_pop_id) AS station_to_city_proximity_rank, "
        "row_number() OVER (PARTITION BY city_coord_pop_id ORDER BY distance_miles, station_id) AS city_to_station_proximity_rank FROM near"
    ),
    "scores": _scorecard(),
    "date_dim": (
        "SELECT d AS date_key, year(d) AS year, month(d) AS month, day(d) AS day_of_month, floor((day(d) - 1) / 7) + 1 AS week_of_month, "
        "dayofyear(d) AS day_of_year, week(d) AS week_of_year, dayofweek(d) AS weekday FROM (SELECT CAST(unnest(range("
        f"(SELECT min(obs_date) FROM stg_obs_daily), DATE '{CALENDAR_END}', INTERVAL 1 DAY)) AS DATE) AS d)"
    ),
}
_PRELUDE = ", ".join(f"{name} AS ({text})" for name, text in _CTES.items()) + "," + sql_gaps(
    "obs_daily_all_qc", "station_id", "obs_date", "tavg_f", w.CARD.min_run
) + (
    ", station_obs_qc AS (SELECT s.station_id, "
    + ", ".join(f"t.{c}" for c in w.STATION_IDENTITY)
    + ", b.lo AS first_obs_date, b.hi AS last_obs_date, b.days AS total_days, date_diff('day', b.lo, b.hi) + 1 AS data_span_days, "
    f"{sql_ratio('b.days', '(date_diff(' + chr(39) + 'day' + chr(39) + ', b.lo, b.hi) + 1)')} AS percent_days_reported, "
    f"{sql_ratio('g.total_gap_days', '(date_diff(' + chr(39) + 'day' + chr(39) + ', b.lo, b.hi) + 1)')} AS pct_gap_days, "
    "g.total_gap_days, g.long_gap_count, s.* EXCLUDE (station_id) FROM scores s JOIN bounds b USING (station_id) "
    "JOIN gap_sum g USING (station_id) JOIN stg_obs_stations t USING (station_id))"
)


def with_models(select: str) -> str:
    """A query over the models' SQL counterparts."""
    return f"WITH {_PRELUDE} {select}"


def _fact(columns: dict[str, str]) -> str:
    return "(SELECT " + ", ".join(f"{a} AS {b}" for a, b in columns.items()) + " FROM obs_daily_all)"


def _cast(column: str, kind: str, rounding: bool = True) -> str:
    value = f"round(round({column}, 6))" if rounding else f"round({column}, 6)"
    return f"CAST({value} AS {kind}) AS {column}"


_KEYED = {**{k: k for k in w.KEYS}, **w.FACT_COLUMNS}
_NARROW = {**{k: k for k in ("station_date_id", *w.KEYS)}, **w.NARROW_COLUMNS}
_FACT_METRICS = [*w.FACT_COLUMNS.values()]
_NARROW_METRICS = [*w.NARROW_COLUMNS.values()]
_HOURLY_STAGED = [*w.HOURLY_CELSIUS.values(), *w.HOURLY_NAMES.values()]
_DAILY_STAGED = [*w.DAILY_CELSIUS.values(), *w.SHARED_NAMES.values()]
_DAY_SUM = [o for o, _, _ in w.DAY_MEASURES]


def _station(rename: dict[str, str]) -> str:
    return ", ".join(
        f"{f'round(s.{c}, 6)' if c in _GEO else f's.{c}'} AS {rename.get(c, c)}" for c in w.STATION_ATTRIBUTES
    )


ORACLES = {
    "stg_obs_daily": sql_select(["obs_date", "station_id", *_DAILY_STAGED, "station_date_id"], _DAILY_STAGED, "stg_obs_daily"),
    "stg_obs_hourly": sql_select(["obs_time", "station_id", *_HOURLY_STAGED, "station_time_id"], _HOURLY_STAGED, "stg_obs_hourly"),
    "stg_obs_stations": sql_select([*_STATION_COLUMNS, "region_name"], _GEO, "stg_obs_stations"),
    "stg_city_coord": sql_select([*w.CITY_COORD_NAMES.values()], _GEO, "stg_city_coord"),
    "stg_city_pop": "SELECT * FROM stg_city_pop",
    "obs_hourly_day_sum": sql_select(["station_date_id", *w.KEYS, *_DAY_SUM], _DAY_SUM, "obs_hourly_day_sum"),
    "obs_daily_window": sql_select(
        ["station_obs_window_id", "station_id", "anchor_date", "obs_date", *_DAILY_STAGED], _DAILY_STAGED, "obs_daily_window"
    ),
    "obs_daily_all": sql_select(["station_date_id", *w.KEYS, *w.DAY_COLUMNS], w.DAY_COLUMNS, "obs_daily_all"),
    "obs_daily_all_qc": sql_select(
        ["station_date_id", *w.KEYS, *w.QC_COLUMNS],
        [c for c in w.QC_COLUMNS if not c.endswith("_source")], "obs_daily_all_qc", _DIFFS,
    ),
    "obs_daily_all_window": sql_select(
        ["station_obs_window_id", "station_id", "anchor_date", "obs_date", *w.DAY_COLUMNS], w.DAY_COLUMNS, "obs_daily_all_window"
    ),
    "station_obs_qc": sql_select(_QC_COLUMNS, _QC_DOUBLES, "station_obs_qc"),
    "city_coord_and_pop": sql_select(
        ["city_coord_pop_id", "uace", "city_pop_id", *w.MATCH_SCORES, "pop_city_name", "population_2023", "coord_city_name",
         "area_land_sqm", "area_water_sqm", "latitude", "longitude"], _GEO, "city_coord_and_pop",
    ),
    "station_city_match": sql_select(_MATCH_COLUMNS, _GEO, "station_city_match"),
    "mart_date_dim": "SELECT * FROM date_dim",
    "mart_obs_fact": sql_select([*_KEYED.values()], _FACT_METRICS, _fact(_KEYED)),
    "mart_obs_window_fact": (
        f"SELECT station_obs_window_id AS station_anchor_obs_id, {sql_key('station_id', 'anchor_date', 'obs_date')} AS station_anchor_id, "
        f"station_id, anchor_date, obs_date, {', '.join(f'round({a}, 6) AS {b}' for a, b in w.NARROW_COLUMNS.items())} FROM obs_daily_all_window"
    ),
    "mart_stations_dim": (
        f"SELECT s.station_id, {_station({})}, s.region_name, s.snapshot_time, "
        "c.distinct_sunshine_minutes_count, c.distinct_tmax_f_count, c.tmax_f_count FROM stg_obs_stations s LEFT JOIN ("
        "SELECT station_id, count(DISTINCT sunshine_minutes) AS distinct_sunshine_minutes_count, "
        "count(DISTINCT tmax_f) AS distinct_tmax_f_count, count(tmax_f) AS tmax_f_count FROM obs_daily_all GROUP BY 1) c USING (station_id)"
    ),
    "mart_city_dim": (
        "SELECT " + ", ".join(f"{f'round({a}, 6)' if a in _GEO else a} AS {b}" for a, b in w.CITY_DIM_NAMES.items()) + " FROM city_coord_and_pop"
    ),
    "mart_city_station_bridge": (
        "SELECT " + ", ".join(f"{f'round({c}, 6)' if c in _GEO else c} AS {w.BRIDGE_NAMES.get(c, c)}" for c in _MATCH_COLUMNS) + " FROM station_city_match"
    ),
    "mart_station_obs_qc_obt": (
        f"SELECT q.station_id, {_station(_STATION_POINT)}, "
        + ", ".join(f"{sql_rounded(f'q.{m}')} AS {m}" if m in _QC_DOUBLES else f"q.{m}" for m in _QC_MEASURES)
        + " FROM station_obs_qc q LEFT JOIN stg_obs_stations s USING (station_id)"
    ),
    "obs_fact": (
        f"SELECT station_id, obs_date, {', '.join(_cast(m, 'FLOAT', False) for m in _FACT_METRICS)} FROM {_fact(_KEYED)}"
    ),
    "obs_fact_cp": (
        "SELECT station_id, obs_date, "
        + ", ".join(
            [*[_cast(m, "SMALLINT") for m in w.SERVE_SMALL], *[_cast(m, "FLOAT") for m in w.SERVE_ROUNDED],
             *[_cast(m, "FLOAT", False) for m in w.SERVE_FLOAT], *[_cast(m, "INTEGER") for m in w.SERVE_UNSIGNED]]
        )
        + f" FROM {_fact(_KEYED)}"
    ),
    "mart_obs_fact_unpiv": (
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT station_date_id, station_id, obs_date, '{b}' AS metric_name, round({a}, 6) AS metric_value FROM obs_daily_all"
            for a, b in w.NARROW_COLUMNS.items()
        )
        + ")"
    ),
    "mart_station_obs_obt": (
        f"SELECT o.station_date_id, o.station_id, {_station({})}, o.obs_date, {', '.join(f'round(o.{m}, 6) AS {m}' for m in _NARROW_METRICS)} "
        f"FROM {_fact(_NARROW)} o LEFT JOIN stg_obs_stations s USING (station_id)"
    ),
}


def _stable(df):
    """Round the metrics before they are narrowed, as the SQL does."""
    return rounded(df)


def register(registry: Registry) -> None:
    def model(name: str):
        def run(spark, sf_dir):
            warehouse = Warehouse(landing_source(spark, sf_dir), calendar_end=CALENDAR_END)
            if name.startswith("obs_fact"):
                warehouse.mart_obs_fact = _stable(warehouse.mart_obs_fact)
                return getattr(warehouse, name)
            result = getattr(warehouse, name)
            return rounded(labelled(result, _DIFFS) if name == "obs_daily_all_qc" else result)

        return run

    for name in MODELS:
        if name != "mart_hour_dim":  # fixed size; registered as hour_dim, joined to facts
            registry.add(f"model_{name}", with_models(ORACLES[name]))(model(name))
