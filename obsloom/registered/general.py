"""The general operators over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from obsloom.functions import calendar, geo, keys, numeric, text
from obsloom.operators import coverage, dims, incremental, matching, merge, proximity, quality, ranking, reshape
from obsloom.operators import rollup, snapshot, staging, windows
from obsloom.operators.skew import lookup_join
from obsloom.registered.common import (
    Registry,
    labelled,
    rounded,
    sql_gaps,
    sql_haversine,
    sql_key,
    sql_ratio,
    sql_round,
    sql_rounded,
    table,
)

_DAY_SPEC = [
    ("value_avg", "avg", "value"),
    ("value_min", "min", "value"),
    ("value_max", "max", "value"),
    ("value_sum", "sum", "value"),
    ("k_avg", "avg", "k"),
    ("k_max", "max", "k"),
    ("k_sum", "sum", "k"),
]
_SQL_K = "CAST(regexp_replace(props, '[^0-9]+', '', 'g') AS BIGINT)"
# The odd divisor keeps averages off exact halves at the last rounded place.
_SQL_EVENTS = f"(SELECT * REPLACE (value / 7.0013e0 AS value), {_SQL_K} AS k FROM events)"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumns(
        {"k": text.digits_to_long("props"), "value": F.col("value") / F.lit(7.0013)}
    )


def _user_days(events, key_name="user_day_id"):
    return rollup.rollup_daily(events, key="user_id", time="ts", date_as="event_date", spec=_DAY_SPEC, key_name=key_name)


def _sql_days(name: str, where: str = "true") -> str:
    return f"""{name} AS (
  SELECT user_id, CAST(ts AS DATE) AS event_date, avg(value) AS value_avg, min(value) AS value_min, max(value) AS value_max,
    sum(value) AS value_sum, avg(k) AS k_avg, max(k) AS k_max, CAST(sum(k) AS BIGINT) AS k_sum
  FROM {_SQL_EVENTS} WHERE {where} GROUP BY ALL)"""


# Two overlapping sources made from the event types.
_FIRST = ("click", "view")
_SECOND = ("view", "signup", "error")
_PAIRS = [
    merge.Pair("value_avg", "value_avg", "value_avg"),
    merge.Pair("value_max", "value_max", "value_max"),
    merge.Pair("k_left", "k_left", "k_left"),
]
_CARD = coverage.Scorecard(
    gap_metric="k_left",
    source_metric="value_avg",
    matched=("value_avg", "k_left"),
    compared=("value_avg", "value_max"),
    zero_counts={"count_zero_k_days": "k_left"},
    ranged=("value_avg", "value_max"),
    low=1,
    high=140,
    min_run=3,
)


def _sides(spark, sf_dir):
    events = _events(spark, sf_dir)
    k_left = F.nullif(F.col("k_max") % 5, F.lit(1)).cast("double")
    sides = [
        _user_days(events.filter(F.col("event_type").isin(*kinds))).withColumn("k_left", k_left)
        for kinds in (_FIRST, _SECOND)
    ]
    return sides[0], sides[1]


def _merged_qc(spark, sf_dir, keep=None):
    first, second = _sides(spark, sf_dir)
    return merge.merge_sources_qc(
        first, second, keys=["user_id", "event_date"], pairs=_PAIRS, carry=["value_min"], key_name="user_day_id", keep_second=keep
    )


_SQL_MERGED = (
    _sql_days("a0", "event_type IN ('click', 'view')")
    + ", "
    + _sql_days("b0", "event_type IN ('view', 'signup', 'error')")
    + """,
a AS (SELECT *, CAST(nullif(k_max % 5, 1) AS DOUBLE) AS k_left FROM a0),
b AS (SELECT *, CAST(nullif(k_max % 5, 1) AS DOUBLE) AS k_left FROM b0),
merged AS (
  SELECT a.user_id, a.event_date, """
    + ", ".join(
        f"coalesce(a.{p.name}, b.{p.name}) AS {p.name}, CASE WHEN a.{p.name} IS NOT NULL AND b.{p.name} IS NOT NULL THEN 'both' "
        f"WHEN a.{p.name} IS NOT NULL THEN 'daily' WHEN b.{p.name} IS NOT NULL THEN 'hourly' END AS {p.name}_source, "
        f"(b.{p.name} - a.{p.name}) / a.{p.name} AS {p.name}_diff_pct, b.{p.name} AS hs_{p.name}"
        for p in _PAIRS
    )
    + """, b.value_min FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.event_date = b.event_date
  UNION ALL
  SELECT b.user_id, b.event_date, """
    + ", ".join(f"b.{p.name}, 'hourly', NULL, b.{p.name}" for p in _PAIRS)
    + """, b.value_min FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = b.user_id AND a.event_date = b.event_date)
)"""
)


def _register_series(registry: Registry) -> None:
    @registry.add(
        "rollup_daily",
        f"WITH {_sql_days('d')} SELECT {sql_key('user_id', 'event_date')} AS user_day_id, user_id, event_date, "
        + ", ".join(o if o in ("k_max", "k_sum") else sql_round(o) for o, _, _ in _DAY_SPEC)
        + " FROM d",
    )
    def rollup_daily(spark, sf_dir):
        return rounded(_user_days(_events(spark, sf_dir)))

    @registry.add(
        "stage_obs",
        f"SELECT ts AS obs_time, user_id AS station_id, round(value * 9.0 / 5.0 + 32.0, 6) AS value_f, event_type AS kind, "
        f"{sql_key('user_id', 'ts')} AS station_time_id FROM events",
    )
    def stage_obs(spark, sf_dir):
        return rounded(
            staging.stage_obs(
                table(spark, sf_dir, "events"), station="user_id", time="ts", time_as="obs_time", to_date=False,
                celsius={"value": "value_f"}, rename={"event_type": "kind"}, key_name="station_time_id",
            )
        )

    @registry.add(
        "merge_sources",
        f"WITH {_SQL_MERGED} SELECT {sql_key('user_id', 'event_date')} AS user_day_id, user_id, event_date, "
        "round(value_avg, 6) AS value_avg, round(value_max, 6) AS value_max, k_left, round(value_min, 6) AS value_min FROM merged",
    )
    def merge_sources(spark, sf_dir):
        first, second = _sides(spark, sf_dir)
        return rounded(
            merge.merge_sources(
                first, second, keys=["user_id", "event_date"], pairs=_PAIRS, carry=["value_min"], key_name="user_day_id"
            )
        )

    diffs = [f"{p.name}_diff_pct" for p in _PAIRS]
    special = ", ".join(
        f"CASE WHEN isfinite({d}) THEN {sql_rounded(d)} END AS {d}, CASE WHEN isnan({d}) THEN 'nan' WHEN {d} = 'inf'::DOUBLE THEN 'inf' "
        f"WHEN {d} = '-inf'::DOUBLE THEN '-inf' END AS {d}_label"
        for d in diffs
    )

    @registry.add(
        "merge_sources_qc",
        f"WITH {_SQL_MERGED} SELECT {sql_key('user_id', 'event_date')} AS user_day_id, user_id, event_date, "
        + ", ".join(f"round({p.name}, 6) AS {p.name}, {p.name}_source" for p in _PAIRS)
        + f", round(value_min, 6) AS value_min, {special} FROM merged",
    )
    def merge_sources_qc(spark, sf_dir):
        return rounded(labelled(_merged_qc(spark, sf_dir), diffs))

    @registry.add(
        "window_expand",
        f"WITH {_sql_days('d')} SELECT {sql_key('a.user_id', 'a.event_date', 'o.event_date')} AS window_id, a.user_id, "
        "a.event_date AS anchor_date, o.event_date, round(o.value_avg, 6) AS value_avg, o.k_max FROM d a JOIN d o "
        "ON a.user_id = o.user_id AND o.event_date BETWEEN a.event_date - INTERVAL 2 DAY AND a.event_date + INTERVAL 2 DAY",
    )
    def window_expand(spark, sf_dir):
        days = _user_days(_events(spark, sf_dir)).select("user_id", "event_date", "value_avg", "k_max")
        return rounded(
            windows.window_expand(days, key="user_id", date="event_date", n=2, key_name="window_id")
        )

    @registry.add(
        "window_expand_repeated",
        f"WITH e AS (SELECT user_id, CAST(ts AS DATE) AS event_date, event_id FROM events) SELECT "
        f"{sql_key('a.user_id', 'a.event_date', 'o.event_date')} AS window_id, a.user_id, a.event_date AS anchor_date, o.event_date, o.event_id "
        "FROM (SELECT DISTINCT user_id, event_date FROM e) a JOIN e o "
        "ON a.user_id = o.user_id AND o.event_date BETWEEN a.event_date - INTERVAL 2 DAY AND a.event_date + INTERVAL 2 DAY",
    )
    def window_expand_repeated(spark, sf_dir):
        """Over the events themselves, several per user and day."""
        events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("event_date"), "event_id")
        return windows.window_expand_repeated(events, key="user_id", date="event_date", n=2, key_name="window_id")

    @registry.add(
        "coverage",
        "SELECT user_id, min(CAST(ts AS DATE)) AS first_obs_date, max(CAST(ts AS DATE)) AS last_obs_date, "
        "date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS data_span_days, "
        "count(DISTINCT CAST(ts AS DATE)) AS total_days, round(CAST(count(DISTINCT CAST(ts AS DATE)) AS DOUBLE) / "
        "(date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1), 6) AS percent_days_reported FROM events GROUP BY user_id",
    )
    def coverage_(spark, sf_dir):
        events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("event_date"))
        return rounded(coverage.coverage(events, key="user_id", date="event_date"))

    gap_base = _sql_days("d0") + ", d AS (SELECT user_id, event_date, nullif(k_max % 5, 1) AS k_left FROM d0)"

    @registry.add(
        "gaps",
        f"WITH {gap_base},{sql_gaps('d', 'user_id', 'event_date', 'k_left', 3)} SELECT user_id, total_gap_days, "
        f"round({sql_ratio('total_gap_days', '(date_diff(' + chr(39) + 'day' + chr(39) + ', lo, hi) + 1)')}, 6) AS pct_gap_days, "
        "long_gap_count, long_gap_periods FROM gap_sum JOIN bounds USING (user_id)",
    )
    def gaps(spark, sf_dir):
        days = _user_days(_events(spark, sf_dir)).withColumn("k_left", F.nullif(F.col("k_max") % 5, F.lit(1)))
        return rounded(coverage.gaps(days, key="user_id", date="event_date", metric="k_left", min_run=3))

    def total(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    def match(m: str) -> str:
        return f"CASE WHEN abs({m}_diff_pct) >= 0.05 THEN 0 ELSE 1 END"

    card_sql = [
        "lo AS first_obs_date", "hi AS last_obs_date", "days AS total_days", "date_diff('day', lo, hi) + 1 AS data_span_days",
        "round(days::DOUBLE / (date_diff('day', lo, hi) + 1), 6) AS percent_days_reported", "total_gap_days", "long_gap_count",
        "round(total_gap_days::DOUBLE / (date_diff('day', lo, hi) + 1), 6) AS pct_gap_days",
        *[f"{total(f'value_avg_source = {v!r}')} AS days_{label}_value_avg" for label, v in (("both", "both"), ("only_daily", "daily"), ("only_hourly", "hourly"))],
        *[f"round({sql_ratio(f'sum({match(m)})', total(f'{m}_source = {chr(39)}both{chr(39)}'))}, 6) AS pct_matched_{m}" for m in _CARD.matched],
        *[f"{total(f'{m}_source = {chr(39)}both{chr(39)} AND {match(m)} = 0')} AS x_cnt_{m}" for m in _CARD.matched],
        *[f"round(avg(abs({m} - hs_{m})), 6) AS avg_abs_diff_{m}, round(max(abs({m} - hs_{m})), 6) AS max_abs_diff_{m}, "
          f"{sql_rounded(f'avg(hs_{m} - {m})')} AS avg_diff_{m}" for m in _CARD.compared],
        f"{total('k_left = 0')} AS count_zero_k_days",
        *[f"{total(f'{m} < 1 OR {m} > 140')} AS count_out_of_range_{m}" for m in _CARD.ranged],
    ]

    @registry.add(
        "qc_summary",
        f"WITH {_SQL_MERGED},{sql_gaps('merged', 'user_id', 'event_date', 'k_left', 3)} "
        f"SELECT user_id, c_name, {', '.join(card_sql)} FROM merged JOIN bounds USING (user_id) JOIN gap_sum USING (user_id) "
        "JOIN customer ON c_custkey = user_id GROUP BY user_id, c_name, lo, hi, days, total_gap_days, long_gap_count",
    )
    def qc_summary(spark, sf_dir):
        people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
        merged = _merged_qc(spark, sf_dir, keep="hs_")
        return rounded(coverage.qc_summary(merged, people, key="user_id", date="event_date", card=_CARD))

    @registry.add(
        "obs_obt",
        f"WITH {_sql_days('d')} SELECT {sql_key('user_id', 'event_date')} AS user_day_id, user_id, event_date, round(value_avg, 6) AS value_avg, "
        "c_name, c_mktsegment FROM d LEFT JOIN customer ON c_custkey = user_id",
    )
    def obs_obt(spark, sf_dir):
        days = _user_days(_events(spark, sf_dir)).select("user_day_id", "user_id", "event_date", "value_avg")
        people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
        return rounded(lookup_join(days, people, ["user_id"], "left", spread=["event_date"]))


_SQL_CUSTOMER_POINTS = "c_custkey, c_custkey * 7919 % 18000 / 100 - 90 AS c_lat, c_custkey * 104729 % 36000 / 100 - 180 AS c_lon"
_SQL_SUPPLIER_POINTS = "s_suppkey, s_suppkey * 6151 % 18000 / 100 - 90 AS s_lat, s_suppkey * 15485 % 36000 / 100 - 180 AS s_lon"
_POINTS = (
    f"points AS (SELECT {_SQL_CUSTOMER_POINTS}, {_SQL_SUPPLIER_POINTS} FROM customer, supplier), "
    f"near AS (SELECT c_custkey, s_suppkey, c_lat, c_lon, s_lat, s_lon, {sql_haversine('c_lat', 'c_lon', 's_lat', 's_lon')} AS distance_miles FROM points), "
    f"ranked AS (SELECT {sql_key('c_custkey', 's_suppkey')} AS pair_id, *, "
    "row_number() OVER (PARTITION BY c_custkey ORDER BY distance_miles, s_suppkey) AS supplier_rank, "
    "row_number() OVER (PARTITION BY s_suppkey ORDER BY distance_miles, c_custkey) AS customer_rank FROM near WHERE distance_miles <= 300)"
)


def _near(spark, sf_dir, **limits):
    customers = table(spark, sf_dir, "customer").selectExpr(*_SQL_CUSTOMER_POINTS.split(", "))
    suppliers = table(spark, sf_dir, "supplier").selectExpr(*_SQL_SUPPLIER_POINTS.split(", "))
    return proximity.proximity_match(
        customers, suppliers, a_id="c_custkey", a_lat="c_lat", a_lon="c_lon", b_id="s_suppkey", b_lat="s_lat", b_lon="s_lon",
        miles=300, key_name="pair_id", a_rank="supplier_rank", b_rank="customer_rank", **limits,
    )


_STATUS = {"O": "open", "F": "finished"}


def _register_dimensions(registry: Registry) -> None:
    def words(text_sql: str) -> str:
        return f"unnest(regexp_split_to_array(lower({text_sql}), '[^a-z0-9]+')) AS word"

    matched_sql = f"""WITH l AS (SELECT p_partkey AS left_key, p_type AS state, {words("p_name || ' ' || p_type")} FROM part),
r AS (SELECT p_partkey AS right_key, p_type AS state, {words("p_name || ' ' || p_brand")} FROM part),
m AS (SELECT left_key, right_key, word FROM l JOIN r USING (word, state) WHERE word <> '')
SELECT left_key, right_key, CAST(sum(length(word)) AS BIGINT) AS total_matched_chars, count(*) AS matched_token_count,
  CAST(coalesce(sum(length(word)) FILTER (WHERE word <> 'red'), 0) AS BIGINT) AS total_matched_chars_no_city,
  count(*) FILTER (WHERE word <> 'red') AS matched_token_count_no_city
FROM m GROUP BY left_key, right_key
QUALIFY row_number() OVER (PARTITION BY left_key ORDER BY total_matched_chars DESC, matched_token_count DESC, right_key) = 1"""

    def matched(spark, sf_dir, **limits):
        part = table(spark, sf_dir, "part")
        names = {side: F.concat_ws(" ", "p_name", other) for side, other in (("left", "p_type"), ("right", "p_brand"))}
        return matching.token_match(
            part.withColumn("name", names["left"]), part.withColumn("name", names["right"]),
            left_id="p_partkey", left_text="name", left_regions=F.array("p_type"),
            right_id="p_partkey", right_text="name", right_region=F.col("p_type"), stop_word="red",
            left_as="left_key", right_as="right_key", **limits,
        )

    @registry.add("token_match", matched_sql)
    def token_match(spark, sf_dir):
        return matched(spark, sf_dir)

    @registry.add("token_match_common", matched_sql)
    def token_match_common(spark, sf_dir):
        """The form for many names, with words of more than three names handled apart."""
        return matched(spark, sf_dir, common_rows=3, direct_pairs=0)

    points = "round(c_lat, 6) AS c_lat, round(c_lon, 6) AS c_lon, round(s_lat, 6) AS s_lat, round(s_lon, 6) AS s_lon"

    near_sql = (
        f"WITH {_POINTS} SELECT pair_id, c_custkey, s_suppkey, {points}, round(distance_miles, 6) AS distance_miles, "
        "supplier_rank, customer_rank FROM ranked"
    )

    @registry.add("proximity_match", near_sql)
    def proximity_match(spark, sf_dir):
        return rounded(_near(spark, sf_dir))

    @registry.add("proximity_divided", near_sql)
    def proximity_divided(spark, sf_dir):
        """The form for many points on both sides, with cells of more than 16 points divided."""
        return rounded(_near(spark, sf_dir, broadcast_rows=0, node_rows=16))

    @registry.add(
        "city_bridge",
        f"WITH {_POINTS} SELECT pair_id AS bridge_id, c_custkey AS station_id, s_suppkey AS city_dim_id, "
        "round(distance_miles, 6) AS distance_miles, supplier_rank AS station_proximity_rank, customer_rank AS city_proximity_rank FROM ranked",
    )
    def city_bridge(spark, sf_dir):
        names = {
            "pair_id": "bridge_id", "c_custkey": "station_id", "s_suppkey": "city_dim_id", "distance_miles": "distance_miles",
            "supplier_rank": "station_proximity_rank", "customer_rank": "city_proximity_rank",
        }
        return rounded(staging.stage_columns(_near(spark, sf_dir), names))

    @registry.add(
        "latest_snapshot",
        "SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' END AS status_name, "
        "o_totalprice, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
    )
    def latest_snapshot(spark, sf_dir):
        newest = snapshot.latest_snapshot(table(spark, sf_dir, "orders"), "o_orderdate")
        return snapshot.with_label(newest, "o_orderstatus", "status_name", _STATUS).select(
            "o_orderkey", "o_custkey", "o_orderstatus", "status_name", "o_totalprice", "o_orderdate"
        )

    @registry.add(
        "date_dim",
        "SELECT d AS date_key, year(d) AS year, month(d) AS month, day(d) AS day_of_month, CAST((day(d) - 1) // 7 + 1 AS DOUBLE) AS week_of_month, "
        "dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, dayofweek(d) AS weekday FROM "
        "(SELECT CAST(unnest(range((SELECT CAST(min(o_orderdate) AS DATE) FROM orders), DATE '2005-03-01', INTERVAL 1 DAY)) AS DATE) AS d)",
    )
    def date_dim(spark, sf_dir):
        return dims.date_dim(table(spark, sf_dir, "orders"), "o_orderdate", dt.date(2005, 3, 1))

    @registry.add(
        "hour_dim",
        "SELECT h.hour, lpad(CAST(h.hour AS VARCHAR), 2, '0') || ':00' AS hour_label, count(e.ts) AS n_events FROM range(0, 24) h(hour) "
        "LEFT JOIN events e ON hour(e.ts) = h.hour GROUP BY h.hour",
    )
    def hour_dim(spark, sf_dir):
        per_hour = table(spark, sf_dir, "events").groupBy(F.hour("ts").cast("bigint").alias("hour")).agg(F.count("ts").alias("n"))
        return dims.hour_dim(spark).join(per_hour, "hour", "left").select(
            "hour", "hour_label", F.coalesce("n", F.lit(0)).alias("n_events")
        )

    @registry.add(
        "stations_dim",
        "SELECT c_custkey, c_name, c_mktsegment, n_priorities, n_days, n_priced FROM customer LEFT JOIN ("
        "SELECT o_custkey AS c_custkey, count(DISTINCT o_orderpriority) AS n_priorities, count(DISTINCT o_orderdate) AS n_days, "
        "count(CASE WHEN o_totalprice > 1000 THEN 1 END) AS n_priced FROM orders GROUP BY 1) USING (c_custkey)",
    )
    def stations_dim(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").withColumn("priced", F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")))
        people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
        return dims.with_counts(
            people, orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey",
            distinct={"n_priorities": "o_orderpriority", "n_days": "o_orderdate"}, present={"n_priced": "priced"},
        )

    @registry.add(
        "row_id",
        "SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS part_id, p_name, p_partkey, p_brand FROM part",
    )
    def row_id(spark, sf_dir):
        part = table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand")
        return ranking.row_id(part, [F.col("p_name").asc_nulls_last(), F.col("p_partkey").asc()], "part_id")

    @registry.add(
        "best_per_key",
        "SELECT o_custkey, o_totalprice, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER "
        "(PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
    )
    def best_per_key(spark, sf_dir):
        return ranking.best_per_key(
            table(spark, sf_dir, "orders"), ["o_custkey"], ["o_totalprice"], ["o_orderkey"], ["o_orderpriority"]
        )

    ranked_sql = "SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS price_rank FROM orders"

    def ranked(spark, sf_dir, **limits):
        orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
        return ranking.rank_within(orders, ["o_custkey"], [F.col("o_totalprice").asc(), F.col("o_orderkey").asc()], "price_rank", **limits)

    @registry.add("rank_within", ranked_sql)
    def rank_within(spark, sf_dir):
        return ranked(spark, sf_dir)

    @registry.add("rank_within_pieces", ranked_sql)
    def rank_within_pieces(spark, sf_dir):
        """The form for groups that no task should hold."""
        return ranked(spark, sf_dir, group_rows=5)

    @registry.add(
        "lookup_join_salted",
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS supplier, s_name FROM lineitem "
        "LEFT JOIN supplier ON s_suppkey = CASE WHEN l_returnflag <> 'N' THEN l_suppkey END",
    )
    def lookup_join_salted(spark, sf_dir):
        """The form for a large second side, with hot keys and many null ones."""
        supplier = F.when(F.col("l_returnflag") != "N", F.col("l_suppkey"))
        lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", supplier.alias("supplier"))
        names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_name")
        return lookup_join(lines, names, ["supplier"], "left", spread=["l_orderkey", "l_linenumber"], broadcast_rows=0, hot_rows=100)


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _register_shapes(registry: Registry) -> None:
    keys_sql = ", ".join(_LINE_KEYS)

    @registry.add(
        "unpivot_metrics",
        " UNION ALL ".join(
            f"SELECT {keys_sql}, '{m}' AS metric_name, {'nullif(l_discount, 0)' if m == 'l_discount' else m} AS metric_value FROM lineitem"
            for m in _LINE_METRICS
        ),
    )
    def unpivot_metrics(spark, sf_dir):
        lines = table(spark, sf_dir, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
        return reshape.unpivot_metrics(lines, _LINE_KEYS, _LINE_METRICS)

    @registry.add(
        "serve_float", f"SELECT {keys_sql}, " + ", ".join(f"CAST({m} AS FLOAT) AS {m}" for m in _LINE_METRICS) + " FROM lineitem"
    )
    def serve_float(spark, sf_dir):
        return reshape.serve_float(table(spark, sf_dir, "lineitem"), _LINE_KEYS, _LINE_METRICS)

    @registry.add(
        "serve_compact",
        f"SELECT {keys_sql}, CAST(round(l_quantity - 25.5) AS SMALLINT) AS quantity_off, CAST(round(l_discount * 10) AS FLOAT) AS discount_tenths, "
        "CAST(l_tax AS FLOAT) AS l_tax, CAST(CAST(round(l_extendedprice / 10) AS USMALLINT) AS INTEGER) AS price_tens FROM lineitem",
    )
    def serve_compact(spark, sf_dir):
        lines = table(spark, sf_dir, "lineitem").select(
            *_LINE_KEYS, (F.col("l_quantity") - 25.5).alias("quantity_off"), (F.col("l_discount") * 10).alias("discount_tenths"),
            "l_tax", (F.col("l_extendedprice") / 10).alias("price_tens"),
        )
        return reshape.serve_compact(
            lines, _LINE_KEYS, small=["quantity_off"], rounded_float=["discount_tenths"], plain_float=["l_tax"], unsigned=["price_tens"]
        )


_NOW = "2024-01-29 12:00:00"
_SQL_STATIONS = (
    "stations AS (SELECT c_custkey AS id, c_mktsegment AS country, c_nationkey AS region, "
    "CASE WHEN c_custkey % 11 > 0 THEN '2024-01-03T00:00:00.000Z' END AS first_at, "
    "concat('2024-', CASE WHEN c_custkey % 2 = 0 THEN '01-' ELSE '02-' END, lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), 'T06:00:00.000Z') AS last_at FROM customer)"
)
_SEGMENTS = ("BUILDING", "MACHINERY", "HOUSEHOLD")


def _stations(spark, sf_dir):
    select = _SQL_STATIONS[len("stations AS (") : -1].replace("FROM customer", "FROM {customer}")
    return spark.sql(select, customer=table(spark, sf_dir, "customer"))


def _log(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("last_fetched"),
        F.when(F.col("o_orderstatus") == "F", "obs_daily").otherwise("obs_hourly").alias("table_name"),
    )


_SQL_LOG = (
    "log AS (SELECT o_custkey AS station_id, CAST(o_orderdate AS TIMESTAMP) AS last_fetched, "
    "CASE WHEN o_orderstatus = 'F' THEN 'obs_daily' ELSE 'obs_hourly' END AS table_name FROM orders)"
)
_SQL_INITIAL = (
    f"WITH {_SQL_STATIONS}, {_SQL_LOG} SELECT DISTINCT id AS station_id, first_at AS start, last_at AS \"end\" FROM stations "
    f"WHERE first_at IS NOT NULL AND last_at IS NOT NULL AND country IN {_SEGMENTS} "
    "AND id NOT IN (SELECT station_id FROM log WHERE table_name = 'obs_daily')"
)


def _sql_increment(step: str, unit: str, limit: str = "") -> str:
    return (
        f"WITH {_SQL_STATIONS}, facts AS (SELECT user_id AS id, max(ts) AS last_time FROM events GROUP BY 1), "
        f"ranges AS (SELECT id AS station_id, coalesce(last_time + INTERVAL 1 {step}, CAST(replace(first_at, 'Z', '') AS TIMESTAMP)) AS start, "
        f"least(CAST(replace(last_at, 'Z', '') AS TIMESTAMP), TIMESTAMP '{_NOW}') AS \"end\" FROM stations LEFT JOIN facts USING (id) "
        f"WHERE first_at IS NOT NULL) SELECT * FROM ranges WHERE CAST(start AS {unit}) <= CAST(\"end\" AS {unit}){limit}"
    )


def _register_loads(registry: Registry) -> None:
    def initial(spark, sf_dir, n):
        return incremental.plan_initial(
            _stations(spark, sf_dir), _log(spark, sf_dir), "obs_daily", start="first_at", end="last_at",
            filters={"country": _SEGMENTS, "region": ()}, n=n,
        )

    registry.add("plan_initial", _SQL_INITIAL)(lambda spark, sf_dir: initial(spark, sf_dir, None))
    registry.add("plan_initial_batch", _SQL_INITIAL + " ORDER BY id LIMIT 25")(lambda spark, sf_dir: initial(spark, sf_dir, 25))

    def increment(spark, sf_dir, step, n=None):
        return incremental.plan_incremental(
            _stations(spark, sf_dir), table(spark, sf_dir, "events"), start="first_at", end="last_at", key="user_id", time="ts",
            step=step, now=calendar.utc(dt.datetime.fromisoformat(_NOW)), n=n,
        )

    registry.add("plan_incremental_daily", _sql_increment("DAY", "DATE"))(lambda spark, sf_dir: increment(spark, sf_dir, "day"))
    registry.add("plan_incremental_hourly", _sql_increment("HOUR", "TIMESTAMP"))(lambda spark, sf_dir: increment(spark, sf_dir, "hour"))
    registry.add("plan_incremental_batch", _sql_increment("HOUR", "TIMESTAMP", " ORDER BY station_id LIMIT 5"))(
        lambda spark, sf_dir: increment(spark, sf_dir, "hour", 5)
    )

    @registry.add(
        "upsert_log",
        f"WITH {_SQL_LOG}, fresh AS (SELECT DISTINCT c_custkey AS station_id FROM customer WHERE c_acctbal > 3000) "
        "SELECT * FROM log WHERE NOT (table_name = 'obs_daily' AND station_id IN (SELECT station_id FROM fresh)) "
        f"UNION ALL SELECT station_id, TIMESTAMP '{_NOW}', 'obs_daily' FROM fresh",
    )
    def upsert_log(spark, sf_dir):
        fresh = table(spark, sf_dir, "customer").filter("c_acctbal > 3000").select(F.col("c_custkey").alias("station_id"))
        return incremental.upsert_log(_log(spark, sf_dir), fresh, "obs_daily", F.lit(_NOW).cast("timestamp_ntz"))

    @registry.add(
        "update_bounds",
        "SELECT o_orderkey, o_custkey, coalesce(CASE WHEN c_acctbal > 3000 THEN concat('new ', c_name) END, o_orderpriority) AS o_orderpriority "
        "FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
    )
    def update_bounds(spark, sf_dir):
        ends = table(spark, sf_dir, "customer").filter("c_acctbal > 3000").select(
            F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("new "), "c_name").alias("new_end")
        )
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        return incremental.update_bounds(orders, ends, id_="o_custkey", column="o_orderpriority", spread=["o_orderkey"])

    @registry.add(
        "new_rows",
        "SELECT DISTINCT event_id, user_id, ts FROM events WHERE (user_id, ts) NOT IN (SELECT user_id, ts FROM events WHERE event_type IN ('click', 'view'))",
    )
    def new_rows(spark, sf_dir):
        events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
        stored = events.filter(F.col("event_type").isin("click", "view"))
        return incremental.new_rows(events.drop("event_type"), stored, ["user_id", "ts"])


def _register_quality(registry: Registry) -> None:
    @registry.add("dq_unique", "SELECT o_custkey AS value, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
    def dq_unique(spark, sf_dir):
        return quality.dq_unique(table(spark, sf_dir, "orders"), "o_custkey")

    @registry.add("dq_not_null", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount FROM lineitem WHERE l_discount = 0")
    def dq_not_null(spark, sf_dir):
        lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("discount"))
        return quality.dq_not_null(lines, "discount")

    @registry.add(
        "dq_relationship",
        "SELECT o_custkey AS value, count(*) AS n_records FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1",
    )
    def dq_relationship(spark, sf_dir):
        known = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
        return quality.dq_relationship(table(spark, sf_dir, "orders"), "o_custkey", known, "c_custkey")


def _register_expressions(registry: Registry) -> None:
    token_sql = "regexp_split_to_array(lower(text), '[^a-z0-9]+')"

    @registry.add(
        "text_functions",
        f"SELECT doc_id, trim(split_part(text, ' ', 2)) AS second, trim(split_part(text, ' ', -1)) AS last, trim(split_part(text, ' ', 100000)) AS missing, "
        f"CAST(len({token_sql}) AS BIGINT) AS n_tokens, CAST(coalesce(list_sum(list_transform({token_sql}, lambda t: length(t))), 0) AS BIGINT) AS n_token_chars, "
        "CAST(regexp_replace(concat(n_chars, ',', doc_id), '[^0-9]+', '', 'g') AS BIGINT) AS digits, lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00' AS hour_label FROM documents",
    )
    def text_functions(spark, sf_dir):
        tokens = text.word_tokens("text")
        return table(spark, sf_dir, "documents").select(
            "doc_id",
            text.nth_part("text", " ", 2).alias("second"),
            text.nth_part("text", " ", -1).alias("last"),
            text.nth_part("text", " ", 100000).alias("missing"),
            F.size(tokens).cast("bigint").alias("n_tokens"),
            F.aggregate(tokens, F.lit(0).cast("bigint"), lambda acc, t: acc + F.length(t)).alias("n_token_chars"),
            text.digits_to_long(F.concat(F.col("n_chars").cast("string"), F.lit(","), F.col("doc_id").cast("string"))).alias("digits"),
            text.hour_label(F.col("doc_id") % 24).alias("hour_label"),
        )

    @registry.add(
        "date_functions",
        "SELECT o_orderkey, CAST((day(o_orderdate) - 1) // 7 + 1 AS DOUBLE) AS week_of_month, dayofweek(o_orderdate) AS weekday, weekofyear(o_orderdate) AS iso_week, "
        "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS span, CAST(o_orderdate + INTERVAL 10 YEAR AS DATE) AS later, "
        "CAST(o_orderdate - INTERVAL 2 DAY AS DATE) AS earlier, least(CAST(o_orderdate AS TIMESTAMP), TIMESTAMP '1998-01-01') AS capped FROM orders",
    )
    def date_functions(spark, sf_dir):
        day = F.col("o_orderdate").cast("date")
        return table(spark, sf_dir, "orders").select(
            "o_orderkey",
            calendar.week_of_month(day).alias("week_of_month"),
            calendar.weekday_from_sunday(day).alias("weekday"),
            F.weekofyear(day).cast("bigint").alias("iso_week"),
            calendar.span_days(F.lit(dt.date(1995, 1, 1)), day).alias("span"),
            F.add_months(day, 120).alias("later"),
            F.date_sub(day, 2).alias("earlier"),
            F.least(F.col("o_orderdate").cast("timestamp_ntz"), calendar.iso_timestamp(F.lit("1998-01-01T00:00:00.000Z"))).alias("capped"),
        )

    quotient = "(l_discount - 0.05::DOUBLE) / l_tax"

    @registry.add(
        "numeric_functions",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity * 9.0 / 5.0 + 32.0, 6) AS quantity_f, "
        f"CASE WHEN isfinite({quotient}) THEN round({quotient}, 6) END AS quotient, CASE WHEN isnan({quotient}) THEN 'nan' WHEN {quotient} = 'inf'::DOUBLE THEN 'inf' "
        f"WHEN {quotient} = '-inf'::DOUBLE THEN '-inf' END AS quotient_label, round(l_discount / nullif(l_tax, 0), 6) AS guarded, "
        "CASE WHEN nullif(l_tax, 0) IS NOT NULL AND nullif(l_discount, 0) IS NOT NULL THEN 'both' WHEN nullif(l_tax, 0) IS NOT NULL THEN 'daily' "
        "WHEN nullif(l_discount, 0) IS NOT NULL THEN 'hourly' END AS present, CASE WHEN abs(nullif(l_discount, 0) - 0.05) >= 0.03 THEN 0 ELSE 1 END AS matches, "
        "l_quantity NOT BETWEEN 10 AND 40 AS outside FROM lineitem",
    )
    def numeric_functions(spark, sf_dir):
        tax, discount = F.nullif("l_tax", F.lit(0.0)), F.nullif("l_discount", F.lit(0.0))
        frame = table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            numeric.c_to_f("l_quantity").alias("quantity_f"),
            numeric.ieee_div(F.col("l_discount") - F.lit(0.05), "l_tax").alias("quotient"),
            numeric.guarded_ratio("l_discount", "l_tax").alias("guarded"),
            numeric.provenance(tax, discount).alias("present"),
            numeric.match_flag(discount - F.lit(0.05), 0.03).alias("matches"),
            numeric.out_of_range("l_quantity", 10, 40).alias("outside"),
        )
        return rounded(labelled(frame, ["quotient"]))

    @registry.add(
        "haversine",
        f"SELECT c_custkey, round({sql_haversine('c_lat', 'c_lon', '40.7', '-74.0')}, 6) AS miles FROM (SELECT {_SQL_CUSTOMER_POINTS} FROM customer)",
    )
    def haversine(spark, sf_dir):
        points = table(spark, sf_dir, "customer").selectExpr(*_SQL_CUSTOMER_POINTS.split(", "))
        return rounded(points.select("c_custkey", geo.haversine_miles("c_lat", "c_lon", F.lit(40.7), F.lit(-74.0)).alias("miles")))

    @registry.add(
        "filters",
        "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN "
        "(left(o_orderpriority, 1), CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'O' END) AND o_orderstatus <> ''",
    )
    def filters(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").withColumns(
            {"a": F.left("o_orderpriority", F.lit(1)), "b": F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("O")}
        )
        kept = incremental.filter_in(incremental.filter_in(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]), "o_orderstatus", [])
        return kept.filter(incremental.in_columns("o_orderstatus", ["a", "b"]) & (F.col("o_orderstatus") != "")).select("o_orderkey", "o_custkey")

    @registry.add(
        "conditional_counts",
        "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, CAST(sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END) AS BIGINT) AS taxed, "
        "round(avg(abs(l_tax - l_discount)), 6) AS avg_gap, round(max(abs(l_tax - l_discount)), 6) AS max_gap FROM lineitem GROUP BY 1",
    )
    def conditional_counts(spark, sf_dir):
        gap = F.abs(F.col("l_tax") - F.col("l_discount"))
        return rounded(
            table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
                numeric.count_if(F.col("l_returnflag") == "R").alias("returned"),
                numeric.sum_if(F.col("l_tax") > 0.04).alias("taxed"),
                F.avg(gap).alias("avg_gap"),
                F.max(gap).alias("max_gap"),
            )
        )

    @registry.add(
        "surrogate_keys",
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_key('l_orderkey', 'l_linenumber', 'CAST(l_shipdate AS DATE)', 'nullif(l_returnflag, ' + chr(39) + 'N' + chr(39) + ')')} AS line_key FROM lineitem",
    )
    def surrogate_keys(spark, sf_dir):
        flag = F.nullif("l_returnflag", F.lit("N"))
        return table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            keys.surrogate_key(["l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date"), flag]).alias("line_key"),
        )


def register(registry: Registry) -> None:
    _register_series(registry)
    _register_dimensions(registry)
    _register_shapes(registry)
    _register_loads(registry)
    _register_quality(registry)
    _register_expressions(registry)
