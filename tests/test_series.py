"""Rollup, merge, window, coverage, gaps and scorecard on hand-made rows and against plain forms."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from obsloom.operators import coverage, merge, rollup, windows

D = dt.date


def test_rollup_day_borders(spark):
    hourly = spark.createDataFrame(
        [
            ("s", dt.datetime(2024, 1, 1, 23, 59), 1.0),
            ("s", dt.datetime(2024, 1, 2, 0, 0), None),
            ("s", dt.datetime(2024, 1, 2, 5, 0), None),
            *[("t", dt.datetime(2024, 1, 1, h), float(h)) for h in range(24)],
        ],
        "k string, t timestamp_ntz, v double",
    )
    spec = [("a", "avg", "v"), ("lo", "min", "v"), ("hi", "max", "v"), ("n", "sum", "v")]
    daily = rollup.rollup_daily(hourly, key="k", time="t", date_as="d", spec=spec)
    assert rows(daily.drop("station_date_id")) == [
        ("s", D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0),
        ("s", D(2024, 1, 2), None, None, None, None),
        ("t", D(2024, 1, 1), 11.5, 0.0, 23.0, 276.0),
    ]


PAIRS = [merge.Pair("v", "v", "w")]


def sides(spark):
    first = spark.createDataFrame(
        [("both", 1, 2.0), ("daily", 1, 5.0), ("null", 1, None), ("zero", 1, 0.0), ("up", 1, 0.0), ("edge", 1, 100.0), (None, 1, 7.0)],
        "k string, d int, v double",
    )
    second = spark.createDataFrame(
        [("both", 1, 3.0), ("null", 1, 4.0), ("zero", 1, 0.0), ("up", 1, 1.0), ("edge", 1, 105.0), ("hourly", 1, 6.0), ("empty", 1, None), (None, 1, 8.0)],
        "k string, d int, w double",
    )
    return first, second


def test_merge_keeps_all_keys_and_prefers_the_first(spark):
    merged = merge.merge_sources(*sides(spark), keys=["k", "d"], pairs=PAIRS)
    assert rows(merged, "k", "v") == sorted(
        [("both", 2.0), ("daily", 5.0), ("null", 4.0), ("zero", 0.0), ("up", 0.0), ("edge", 100.0), ("hourly", 6.0), ("empty", None),
         (None, 7.0), (None, 8.0)],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def test_merge_provenance_and_difference(spark):
    merged = merge.merge_sources_qc(*sides(spark), keys=["k", "d"], pairs=PAIRS).filter("k is not null")
    got = {r["k"]: (r["v_source"], r["v_diff_pct"]) for r in merged.collect()}
    assert got.pop("zero")[0] == "both" and got["up"] == ("both", math.inf)
    assert got == {
        "both": ("both", 0.5), "daily": ("daily", None), "null": ("hourly", None), "up": ("both", math.inf),
        "edge": ("both", 0.05), "hourly": ("hourly", None), "empty": ("hourly", None),
    }


def random_days(seed, keys=4, span=400, share=0.4):
    random.seed(seed)
    start = D(2022, 11, 1)
    return [
        (f"k{k}", start + dt.timedelta(days=i), None if random.random() < 0.2 else float(i))
        for k in range(keys)
        for i in range(span)
        if random.random() < share
    ]


def test_both_window_forms_equal_the_range_form(spark):
    data = [*random_days(1), ("k0", D(2024, 2, 28), 1.0), ("k0", D(2024, 3, 1), 2.0), ("one", D(2024, 1, 1), 3.0), ("k0", D(2022, 11, 20), 9.0)]
    frame = spark.createDataFrame(data, "k string, d date, v double")
    for n in (0, 2, 40):
        expected = sorted(
            [(k, a, d, v) for k, a in {r[:2] for r in data} for kk, d, v in data if kk == k and abs((d - a).days) <= n],
            key=lambda t: tuple((v is None, str(v)) for v in t),
        )
        for form in (windows.window_expand, windows.window_expand_repeated):
            assert rows(form(frame, key="k", date="d", n=n), "k", "anchor_date", "d", "v") == expected


def test_window_expand_of_bare_dates(spark):
    frame = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 1, 3)), ("a", D(2024, 1, 6))], "k string, d date")
    assert windows.window_expand(frame, key="k", date="d").count() == 5


def spine_gaps(data, min_run):
    """Every day of every key, walked one by one."""
    out = {}
    for key in {r[0] for r in data}:
        own = [(d, v) for k, d, v in data if k == key]
        lo, hi = min(d for d, _ in own), max(d for d, _ in own)
        valued = {d for d, v in own if v is not None}
        runs, run = [], 0
        for i in range((hi - lo).days + 2):
            day = lo + dt.timedelta(days=i)
            if day <= hi and day not in valued:
                run += 1
            elif run:
                runs.append(run)
                run = 0
        out[key] = (sum(runs), sum(r for r in runs if r >= min_run), sum(r >= min_run for r in runs), (hi - lo).days + 1)
    return out


@pytest.mark.parametrize("seed, share, min_run", [(1, 0.4, 3), (2, 0.02, 30), (3, 0.9, 1), (4, 0.01, 100)])
def test_gaps_equal_the_walk(spark, seed, share, min_run):
    data = [("full", D(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(5)] + [("null", D(2023, 12, 30), None), ("null", D(2024, 2, 2), None)]
    data += random_days(seed, span=1200, share=share) + [("single", D(2024, 1, 1), 1.0)]
    frame = spark.createDataFrame(data, "k string, d date, v double")
    expected = spine_gaps(data, min_run)
    got = coverage.gaps(frame, key="k", date="d", metric="v", min_run=min_run, keep_gapless=True).collect()
    assert {r["k"]: (r["total_gap_days"], r["long_gap_count"], r["long_gap_periods"]) for r in got} == {
        k: v[:3] for k, v in expected.items()
    }
    for r in got:
        assert r["pct_gap_days"] == pytest.approx(r["total_gap_days"] / expected[r["k"]][3])
    default = coverage.gaps(frame, key="k", date="d", metric="v", min_run=min_run)
    assert {r["k"] for r in default.collect()} == {k for k, v in expected.items() if v[0]}


def test_gaps_before_1970_and_across_blocks(spark):
    start = D(1969, 9, 1)
    kept = [0, 1, 62, 63, 64, 65, 127, 128, 129, 190, 191, 192, 193, 255, 256, 400]
    data = [("k", start + dt.timedelta(days=i), None if i in (0, 193) else 1.0) for i in kept]
    frame = spark.createDataFrame(data, "k string, d date, v double")
    for min_run in (1, 2, 60, 61, 62, 63, 143, 144):
        row = coverage.gaps(frame, key="k", date="d", metric="v", min_run=min_run).first()
        assert tuple(row[c] for c in ("total_gap_days", "long_gap_count", "long_gap_periods")) == spine_gaps(data, min_run)["k"][:3]


@pytest.mark.parametrize("gap, counted", [(29, 0), (30, 30), (31, 31)])
def test_long_gap_counts_days(spark, gap, counted):
    frame = spark.createDataFrame([("s", D(2023, 12, 20), 1.0), ("s", D(2023, 12, 21) + dt.timedelta(days=gap), 1.0)], "k string, d date, v double")
    row = coverage.gaps(frame, key="k", date="d", metric="v").first()
    assert (row["total_gap_days"], row["long_gap_count"], row["long_gap_periods"]) == (gap, counted, int(counted > 0))


def test_repeated_rows_count_once(spark):
    data = [("s", D(2024, 1, 1), None), ("s", D(2024, 1, 1), 1.0), ("s", D(2024, 1, 3), 1.0), ("s", D(2024, 1, 3), 1.0)]
    frame = spark.createDataFrame(data, "k string, d date, v double")
    row = coverage.coverage(frame, key="k", date="d").first()
    assert (row["total_days"], row["data_span_days"], row["percent_days_reported"]) == (2, 3, pytest.approx(2 / 3))
    assert coverage.gaps(frame, key="k", date="d", metric="v").first()["total_gap_days"] == 1


def test_scorecard(spark):
    first = spark.createDataFrame(
        [("s", D(2024, 1, 1), 10.0), ("s", D(2024, 1, 2), 0.0), ("s", D(2024, 1, 5), 150.0), ("full", D(2024, 1, 1), 1.0)],
        "k string, d date, v double",
    )
    second = spark.createDataFrame(
        [("s", D(2024, 1, 1), 10.2), ("s", D(2024, 1, 2), 0.0), ("s", D(2024, 1, 6), -100.0), ("full", D(2024, 1, 1), 1.0)],
        "k string, d date, w double",
    )
    merged = merge.merge_sources_qc(first, second, keys=["k", "d"], pairs=PAIRS, keep_second="hs_")
    card = coverage.Scorecard(
        gap_metric="v", source_metric="v", matched=("v",), compared=("v",), zero_counts={"zeros": "v"}, ranged=("v",)
    )
    names = spark.createDataFrame([("s", "Station"), ("full", "Gapless"), ("none", "Silent")], "k string, name string")
    got = coverage.qc_summary(merged, names, key="k", date="d", card=card).collect()
    assert len(got) == 1  # no gap, no row
    row = got[0].asDict()
    assert row["name"] == "Station" and row["total_gap_days"] == 2 and row["total_days"] == 4 and row["data_span_days"] == 6
    assert (row["days_both_v"], row["days_only_daily_v"], row["days_only_hourly_v"]) == (2, 1, 1)
    # 0 against 0 is a mismatch; days without a difference match, so the share may pass 1.
    assert row["x_cnt_v"] == 1 and row["pct_matched_v"] == 1.5
    assert row["avg_abs_diff_v"] == pytest.approx(0.2 / 3) and row["max_abs_diff_v"] == pytest.approx(0.2)
    assert row["avg_diff_v"] == pytest.approx(0.2 / 3) and row["zeros"] == 1 and row["count_out_of_range_v"] == 2
    kept = coverage.qc_summary(merged, names, key="k", date="d", card=card, keep_gapless=True)
    assert {r["k"] for r in kept.collect()} == {"s", "full"}


def test_scorecard_skips_null_dates(spark):
    frame = spark.createDataFrame([("s", None, 1.0), ("s", D(2024, 1, 1), 1.0)], "k string, d date, v double")
    row = coverage.coverage(frame, key="k", date="d").first()
    assert row["total_days"] == 1 and row["first_obs_date"] == D(2024, 1, 1)
    assert coverage.gaps(frame, key="k", date="d", metric="v", keep_gapless=True).select(F.sum("total_gap_days")).first()[0] == 0
