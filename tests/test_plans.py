"""Physical plans: how often rows are shuffled, what is broadcast and what reaches the scan."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from obsloom.operators import coverage, incremental, merge, proximity, ranking, reshape, rollup, snapshot, windows

SPEC = [("v", "avg", "value"), ("hi", "max", "value")]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(Path(tmp_path_factory.mktemp("plans")) / "events")
    spark.range(2000).select(
        (F.col("id") % 20).alias("k"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(id % 90, id % 24)")).alias("t"),
        F.col("id").cast("double").alias("value"),
        F.lit("x").alias("unused"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def daily(events):
    return rollup.rollup_daily(events, key="k", time="t", date_as="d", spec=SPEC)


def shuffles(text: str) -> int:
    return len(re.findall(r"\bExchange (hash|range|Single|Round)", text))


def test_rollup_combines_before_its_one_shuffle(events, capsys):
    text = plan(daily(events), capsys)
    assert shuffles(text) == 1 and "partial_avg" in text and "unused" not in text


def test_filters_reach_the_scan(events, capsys):
    text = plan(daily(events.filter("value > 100")), capsys)
    assert "GreaterThan(value,100.0)" in text


def test_merge_is_one_full_join(spark, events, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = [merge.Pair("v", "v", "v")]
        text = plan(merge.merge_sources(daily(events), daily(events.filter("k > 3")), keys=["k", "d"], pairs=pairs), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One shuffle per rollup; a join that needed its own would make it four.
    assert text.count("FullOuter") == 1 and shuffles(text) == 2


def test_window_reads_and_shuffles_once(events, capsys):
    stored = events.select("k", F.col("t").cast("date").alias("d"), "value")
    text = plan(windows.window_expand(stored, key="k", date="d"), capsys)
    assert shuffles(text) == 1 and "Join" not in text and text.count("FileScan") == 1


def test_gaps_shuffle_reduced_rows_only(events, capsys):
    stored = events.select("k", F.col("t").cast("date").alias("d"), "value")
    text = plan(coverage.gaps(stored, key="k", date="d", metric="value"), capsys)
    assert shuffles(text) == 2 and text.count("FileScan") == 1 and "Join" not in text
    assert "partial_bit_or" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_distance_join_is_an_equi_join(spark, capsys):
    a = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 90).alias("alat"), F.col("id").alias("alon"))
    b = spark.range(100).select(F.col("id").alias("b"), (F.col("id") % 90).alias("blat"), F.col("id").alias("blon"))
    pairs = proximity.distance_join(a, b, a_id="a", a_lat="alat", a_lon="alon", b_id="b", b_lat="blat", b_lon="blon", miles=50)
    text = plan(pairs, capsys)
    assert "HashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_newest_snapshot_broadcasts_one_row(events, capsys):
    text = plan(snapshot.latest_snapshot(events, "t"), capsys)
    assert "NestedLoop" not in text and "BroadcastHashJoin" in text


def test_narrowing_and_unpivoting_do_not_shuffle(events, capsys):
    assert shuffles(plan(reshape.unpivot_metrics(events, ["k"], ["value"]), capsys)) == 0
    assert shuffles(plan(reshape.serve_float(events, ["k"], ["value"]), capsys)) == 0


def test_best_row_is_cut_off_before_the_shuffle(events, capsys):
    best = plan(ranking.best_per_key(events, ["k"], ["value"], ["t"]), capsys)
    fresh = plan(incremental.new_rows(events, events.limit(0), ["k"]), capsys)
    for text in (best, fresh):
        assert text.count("WindowGroupLimit") == 2 and "SortAggregate" not in text
    assert shuffles(best) == 1 and "unused" not in best
