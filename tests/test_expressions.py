from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from obsloom.functions import calendar, geo, keys, lookups, numeric, text
from obsloom.operators import dims, incremental, quality, reshape, snapshot, staging


def one(spark, column, **values):
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, value if not isinstance(value, (int, float, str)) else F.lit(value))
    return frame.select(column.alias("v")).first()[0]


@pytest.mark.parametrize("celsius, fahrenheit", [(0.0, 32.0), (-40.0, -40.0), (10.1, 10.1 * 9.0 / 5.0 + 32.0)])
def test_celsius(spark, celsius, fahrenheit):
    assert one(spark, numeric.c_to_f("c"), c=celsius) == fahrenheit


def test_celsius_of_null(spark):
    assert one(spark, numeric.c_to_f("c"), c=F.lit(None).cast("double")) is None


def test_division_follows_ieee(spark):
    frame = spark.createDataFrame(
        [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 0.0), (None, 2.0), (1.0, None)], "a double, b double"
    )
    got = [r[0] for r in frame.select(numeric.ieee_div("a", "b")).collect()]
    assert got[:2] == [math.inf, -math.inf] and math.isnan(got[2]) and got[3:] == [1.5, None, None, None]


def test_match_flag_counts_null_as_match_and_nan_as_mismatch(spark):
    frame = spark.createDataFrame([(None,), (0.049,), (0.05,), (-0.05,), (math.nan,), (math.inf,)], "d double")
    assert [r[0] for r in frame.select(numeric.match_flag("d")).collect()] == [1, 1, 0, 0, 0, 0]


def test_guarded_ratio(spark):
    assert one(spark, numeric.guarded_ratio("a", "b"), a=1, b=0) is None
    assert one(spark, numeric.guarded_ratio("a", "b"), a=1, b=2) == 0.5


def test_digits(spark):
    frame = spark.createDataFrame([("1,234,567",), ("8 100",)], "t string")
    assert [r[0] for r in frame.select(text.digits_to_long("t")).collect()] == [1234567, 8100]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("none",)], "t string").select(text.digits_to_long("t")).collect()


def test_parts_and_tokens(spark):
    name = "New York--Newark, NY--NJ"
    states = text.parts_of(F.split_part("t", F.lit(","), F.lit(2)), "--")
    assert one(spark, states, t=name) == ["NY", "NJ"]
    assert one(spark, text.nth_part("t", ",", -1), t=name) == "NY--NJ"
    assert one(spark, text.word_tokens("t"), t="Big (City)") == ["big", "city", ""]


def test_surrogate_key(spark):
    got = one(spark, keys.surrogate_key(["a", "d", "n"]), a="x", d=F.lit(dt.date(2024, 1, 2)), n=F.lit(None).cast("string"))
    assert got == hashlib.md5(f"x-2024-01-02-{keys.NULL_TOKEN}".encode()).hexdigest()


def test_calendar_starts_at_first_fact_and_leaves_out_its_end(spark):
    facts = spark.createDataFrame([(dt.date(2023, 12, 30),), (dt.date(2024, 2, 1),)], "d date")
    days = dims.date_dim(facts, "d", dt.date(2024, 3, 1))
    got = {r["date_key"]: r for r in days.collect()}
    assert min(got) == dt.date(2023, 12, 30) and max(got) == dt.date(2024, 2, 29) and len(got) == 62
    assert got[dt.date(2023, 12, 30)]["weekday"] == 6 and got[dt.date(2023, 12, 31)]["weekday"] == 0
    assert got[dt.date(2024, 2, 29)]["day_of_year"] == 60 and got[dt.date(2024, 2, 29)]["week_of_month"] == 5.0
    assert got[dt.date(2024, 1, 7)]["week_of_month"] == 1.0 and got[dt.date(2024, 1, 8)]["week_of_month"] == 2.0
    assert dims.date_dim(facts.filter("d is null"), "d", dt.date(2024, 3, 1)).count() == 0
    assert dims.date_dim(facts, "d", dims.ten_years_from_today()).agg(F.max("date_key")).first()[0].year >= 2034


def test_iso_week_of_december(spark):
    assert one(spark, calendar.date_parts("d")["week_of_year"], d=F.lit(dt.date(2024, 12, 30))) == 1


def test_hour_dim_has_all_hours_unless_told_otherwise(spark):
    assert dims.hour_dim(spark, 23).count() == 23 and dims.hour_dim(spark, 23).filter("hour = 23").isEmpty()
    assert dims.hour_dim(spark).filter("hour = 23").first()["hour_label"] == "23:00"


def test_lookup_tables():
    assert len(lookups.US_STATES) == 50 and len(lookups.US_REGIONS) == 56


def test_haversine(spark):
    same = one(spark, geo.haversine_miles("a", "b", "a", "b"), a=40.0, b=-70.0)
    quarter = one(spark, geo.haversine_miles("a", "b", "c", "b"), a=0.0, b=0.0, c=90.0)
    half = one(spark, geo.haversine_miles("a", "b", "a", "c"), a=0.0, b=-90.0, c=90.0)
    assert same == 0 and quarter == pytest.approx(3959 * math.pi / 2) and half == pytest.approx(3959 * math.pi)


def test_newest_snapshot_and_labels(spark):
    stations = spark.createDataFrame(
        [("a", "NY", "2024-01"), ("a", "NY", "2024-02"), ("b", "XX", "2024-02"), ("c", None, "2024-02"), ("d", "PR", "2024-01")],
        "id string, region string, taken string",
    )
    labelled = snapshot.with_label(snapshot.latest_snapshot(stations, "taken"), "region", "name", lookups.US_REGIONS)
    assert rows(labelled, "id", "name") == [("a", "New York"), ("b", None), ("c", None)]


def test_numbered_names_break_ties_and_put_nulls_last(spark):
    cities = spark.createDataFrame([("b", "1,000", 1), ("a", "2", 3), ("a", "3", 2), (None, "4", 4)], "n string, p string, r int")
    staged = staging.stage_numbered(
        cities, name="n", name_as="name", amount="p", amount_as="pop", id_as="id", tie_break=["r"]
    )
    assert rows(staged) == [(1, "a", 3), (2, "a", 2), (3, "b", 1000), (4, None, 4)]


def test_unpivot_keeps_nulls(spark):
    wide = spark.createDataFrame([(1, 1.0, None), (2, None, None)], "id int, a double, b double")
    assert rows(reshape.unpivot_metrics(wide, ["id"], ["a", "b"])) == [
        (1, "a", 1.0), (1, "b", None), (2, "a", None), (2, "b", None)
    ]


def compact(spark, small=None, unsigned=None):
    frame = spark.createDataFrame([(1, small, unsigned)], "id int, s double, u double")
    return reshape.serve_compact(frame, ["id"], small=["s"], rounded_float=[], plain_float=[], unsigned=["u"]).first()[1:]


def test_compact_rounds_half_away_from_zero(spark):
    assert compact(spark, 2.5, 2.5) == (3, 3)
    assert compact(spark, -2.5, 65535.4) == (-3, 65535)
    assert compact(spark, 32767.4) == (32767, None)


@pytest.mark.parametrize("small, unsigned", [(32768.0, None), (None, -1.0), (None, 65536.0)])
def test_compact_raises_on_overflow(spark, small, unsigned):
    with pytest.raises(Exception, match="outside"):
        compact(spark, small, unsigned)


def test_data_tests(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    assert rows(quality.dq_unique(child, "k")) == [(1, 2), (3, 2)]
    assert quality.dq_not_null(child, "k").count() == 2
    assert rows(quality.dq_relationship(child, "k", parent, "p")) == [(3, 2)]


def test_filters(spark):
    frame = spark.createDataFrame([("a", "a", "b"), ("b", "a", "a"), (None, "a", "b")], "x string, p string, q string")
    assert frame.filter(incremental.in_columns("x", ["p", "q"])).count() == 1
    assert incremental.filter_in(frame, "x", []).count() == 3
    assert incremental.filter_in(frame, "x", ["b"]).count() == 1


def test_repeated_keys_are_shuffled_as_hashes(spark):
    """Values that occur again are counted as before, nulls are not, and one value may hold most rows."""
    keys = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.concat(F.lit("k"), F.greatest(F.col("id"), F.lit(400)))).alias("k"))
    keys = keys.unionAll(spark.createDataFrame([("k777",), ("k778",), ("",), ("",)], "k string"))
    got = quality.dq_repeated(keys, "k")
    assert rows(got) == [(4,)] == rows(quality.dq_unique_and_nulls(keys, "k", []))
    assert rows(quality.dq_repeated(keys.limit(0), "k")) == [(0,)]
    assert rows(quality.dq_repeated(keys.filter("k IS NULL"), "k")) == [(0,)]
