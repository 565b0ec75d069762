"""Name matching, proximity, ranking and the joins for hot keys, against plain forms."""

from __future__ import annotations

import math
import random
import re

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from obsloom.functions.text import parts_of
from obsloom.operators import matching, proximity, quadtree, ranking, skew, tiles


def brute_match(left, right, stop="city"):
    def bag(t):
        return [w for w in re.split("[^a-z0-9]+", t.lower()) if w]

    best = []
    for lid, ltext, states in left:
        scored = []
        for rid, rtext, state in right:
            if state not in states or state is None:
                continue
            shared = [w for w in bag(ltext) for x in bag(rtext) if w == x]
            if shared:
                plain = [w for w in shared if w != stop]
                scored.append((-sum(map(len, shared)), -len(shared), rid, sum(map(len, plain)), len(plain)))
        if scored:
            chars, count, rid, plain_chars, plain_count = min(scored)
            best.append((lid, rid, -chars, -count, plain_chars, plain_count))
    return sorted(best)


def match(spark, left, right, **options):
    lefts = spark.createDataFrame(left, "l long, name string, states array<string>")
    rights = spark.createDataFrame(right, "r long, name string, state string")
    return matching.token_match(
        lefts, rights, left_id="l", left_text="name", left_regions=F.col("states"), right_id="r", right_text="name",
        right_region=F.col("state"), **options,
    )


def test_repeated_words_multiply(spark):
    left = [(1, "New York--Newark, NY--NJ", ["NY", "NJ", "", ""]), (2, "Nowhere, DC", ["DC", "", "", ""]), (3, "City, NY", ["NY"])]
    right = [(1, "New York city, New York", "NY"), (2, "Newark city, New Jersey", "NJ"), (3, "Washington city, District of Columbia", None), (4, "Ny city, New York", "NY")]
    got = sorted(tuple(r) for r in match(spark, left, right).collect())
    assert got == brute_match(left, right)
    assert got[0][:4] == (1, 1, 14, 4)  # two times new (3), two times york (4)


def random_names(seed, n, words, states):
    random.seed(seed)
    return [(i, " ".join(random.choices(words, k=random.randint(1, 4))), random.choice(states)) for i in range(n)]


@pytest.mark.parametrize("common_rows, direct_pairs", [(100, 10**9), (100, 0), (5, 0), (1, 0), (0, 0)])
def test_common_words_are_exact(spark, common_rows, direct_pairs):
    words = ["city", "city", "new", "york", "fort", "worth", *[f"w{i}" for i in range(40)]]
    right = random_names(1, 150, words, ["A", "B", "C", None])
    left = [(i, name, sorted({s or "A", random.choice("ABC")})) for i, name, s in random_names(2, 80, words, ["A", "B"])]
    left += [(1000 + i, "city new", ["A", "B"]) for i in range(20)]
    got = sorted(tuple(r) for r in match(spark, left, right, common_rows=common_rows, direct_pairs=direct_pairs).collect())
    assert got == brute_match(left, right)


def test_common_words_are_joined_on_subsets_not_pairs(spark):
    """Different names of four words out of thirty: twice the names give about twice the rows, not four times."""
    made = []
    for n in (400, 800):
        names = random_names(n, n, [f"w{i}" for i in range(30)], ["A"])
        sets = spark.createDataFrame([(s, sorted((w, 1) for w in set(name.split())), i) for i, name, s in names], "state string, words array<struct<token: string, times: int>>, _right long")
        got = matching._by_subsets(sets.select("state", F.col("words").alias("left_set")), sets.select("state", F.col("words").alias("right_set"), "_right"), "city")
        made.append(got.count())
    assert made[1] < 2.5 * made[0]


def test_states_part_of_a_name(spark):
    frame = spark.createDataFrame([("A--B, NY--NJ--PA--DE--MD",)], "n string")
    states = frame.select(parts_of(F.split_part("n", F.lit(","), F.lit(2)), "--")).first()[0]
    assert states == ["NY", "NJ", "PA", "DE", "MD"]


def miles(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 3959 * math.asin(min(1, math.sqrt(h)))


def points(seed, n):
    random.seed(seed)
    fixed = [(90.0, 0.0), (-90.0, 50.0), (0.0, 180.0), (0.0, -180.0), (0.0, 179.9), (89.9, 100.0), (89.9, -80.0), (-0.001, 0.0), (45.0, 45.0)]
    around = [(random.uniform(86, 90), random.uniform(-180, 180)) for _ in range(n // 4)]
    line = [(random.uniform(-60, 60), random.choice([1, -1]) * random.uniform(178, 180)) for _ in range(n // 4)]
    rest = [(random.uniform(-90, 90), random.uniform(-180, 180)) for _ in range(n - 2 * (n // 4))]
    return fixed + around + line + rest


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "node_rows": 3}])
@pytest.mark.parametrize("radius", [1, 100, 700, 5000, 13000])
def test_distance_join_equals_all_pairs(spark, radius, options):
    a, b = points(1, 150), points(2, 120)
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(a)] + [(-1, None, 0.0)], "a long, alat double, alon double")
    right = spark.createDataFrame([(i, *p) for i, p in enumerate(b)] + [(-1, 0.0, None)], "b long, blat double, blon double")
    got = proximity.distance_join(
        left, right, a_id="a", a_lat="alat", a_lon="alon", b_id="b", b_lat="blat", b_lon="blon", miles=radius, **options
    ).collect()
    expected = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if miles(p, q) <= radius}
    assert len(got) == len(expected)
    assert {(r["a"], r["b"]) for r in got} == expected


def test_dense_cells_are_divided(spark):
    """100,000 points in one cell, a third of them at one place: no piece has many rows of either side."""
    spread_out = F.when(F.col("id") % 3 == 0, F.lit(0.5))
    a = spark.range(100_000).select(
        F.col("id").alias("a"), F.lit(0).alias("_band"), F.lit(0).alias("_cell"),
        F.coalesce(spread_out, F.rand(1)).alias("_lat"), F.coalesce(spread_out, F.rand(2)).alias("_lon"),
    ).select("*", F.col("_lat").alias("_up"), F.col("_lon").alias("_along"))
    b = spark.range(5_000).select(
        F.col("id").alias("b"), F.lit(0).alias("_band"), F.lit(0).alias("_cell"),
        F.coalesce(spread_out, F.rand(3)).alias("_blat"), F.coalesce(spread_out, F.rand(4)).alias("_blon"),
    )
    left, right, node = quadtree.divided(a, b, a_id="a", b_id="b", angle=math.radians(0.02), node_rows=1_000)
    for side in (left, right):
        assert side.groupBy(*node).count().agg(F.max("count")).first()[0] < 1_200
    compared = left.groupBy(*node).count().join(right.groupBy(*node).agg(F.count("*").alias("m")), node)
    # Those of the one place have to be compared; of the others, few pairs are near enough.
    at_place = 33_334 * 1_667
    assert at_place <= compared.agg(F.sum(F.col("count") * F.col("m"))).first()[0] < at_place + 0.05 * 100_000 * 5_000
    assert left.select("a", "_i").distinct().count() <= 100_000


def test_proximity_ranks_and_radius(spark):
    degree = math.degrees(1 / 3959)
    left = spark.createDataFrame([(1, 0.0, 0.0, "x"), (2, 0.0, 0.0, "y")], "a long, alat double, alon double, aname string")
    right = spark.createDataFrame(
        [(1, 0.0, 99.9 * degree, "far"), (2, 0.0, 100.1 * degree, "out"), (3, 0.0, 0.0, "same"), (4, 0.0, -99.9 * degree, "west")],
        "b long, blat double, blon double, bname string",
    )
    got = proximity.proximity_match(
        left, right, a_id="a", a_lat="alat", a_lon="alon", b_id="b", b_lat="blat", b_lon="blon", miles=100, a_rank="ra", b_rank="rb"
    )
    assert [(r["a"], r["bname"], r["ra"], r["rb"]) for r in got.collect()] == [
        (1, "same", 1, 1), (1, "far", 2, 1), (1, "west", 3, 1), (2, "same", 1, 2), (2, "far", 2, 2), (2, "west", 3, 2)
    ]


def test_row_id_is_dense_and_in_order(spark):
    frame = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1009 % 10).alias("v")).repartition(7)
    got = ranking.row_id(frame, [F.col("v").asc_nulls_last(), F.col("id").desc()], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 1001))
    assert [(r["v"], -r["id"]) for r in got] == sorted((r["v"], -r["id"]) for r in got)


@pytest.mark.parametrize("group_rows", [10_000, 10])
def test_rank_within_a_hot_key(spark, group_rows):
    random.seed(5)
    data = [(None if k == "none" else k, float(random.randint(0, 5)), i) for i, k in enumerate(["hot"] * 700 + ["none"] * 50 + [f"k{j % 40}" for j in range(400)])]
    frame = spark.createDataFrame(data, "k string, v double, id long").repartition(5)
    got = ranking.rank_within(frame, ["k"], [F.col("v").asc(), F.col("id").asc()], "n", group_rows=group_rows)
    expected = []
    for key in {d[0] for d in data}:
        own = sorted(d[1:] for d in data if d[0] == key)
        expected += [(key, v, i, n) for n, (v, i) in enumerate(own, 1)]
    assert rows(got) == sorted(expected, key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    fact = spark.createDataFrame([("hot" if i % 3 else f"k{i % 17}", i) for i in range(600)] + [(None, -1)], "k string, i long")
    dim = spark.createDataFrame([("hot", "a"), ("hot", "b"), *[(f"k{i}", str(i)) for i in range(0, 17, 2)], (None, "n")], "k string, d string")
    plain = fact.join(dim, ["k"], how)
    salted = skew.lookup_join(fact, dim, ["k"], how, spread=["i"], broadcast_rows=0, hot_rows=50)
    assert rows(salted) == rows(plain)
    assert skew.hot_keys(fact, ["k"], 50).collect() == [("hot", 8)]
    assert rows(skew.lookup_join(fact, dim, ["k"], how, spread=["i"])) == rows(plain)


def test_hot_keys_are_bounded(spark):
    """However many keys are hot, fewer than ``most`` are named, the hottest first."""
    fact = spark.range(1000).select(F.when(F.col("id") < 500, F.lit(0)).otherwise(F.col("id") % 50).alias("k"))
    assert skew.hot_keys(fact, ["k"], 5).count() == 50
    assert skew.hot_keys(fact, ["k"], 5, most=10).collect() == [(0, 102)]


def test_broadcast_is_decided_by_rows_and_bytes(spark):
    few = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert skew.at_most(few, 10) and not skew.at_most(few, 9)
    assert not skew.at_most(few, 10, size=9_999) and skew.at_most(few, 10, size=11_000)
    assert skew.at_most(few.limit(0), 0)


def test_best_per_key(spark):
    frame = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 5, "y"), ("a", 0, 4, "z"), ("b", 9, 1, "w")], "k string, id int, s int, t string")
    assert rows(ranking.best_per_key(frame, ["k"], ["s"], ["id"], ["t"])) == [("a", 1, 5, "x"), ("b", 9, 1, "w")]
    tied = frame.unionByName(spark.createDataFrame([("a", 1, 5, "c"), ("b", 9, None, "n")], frame.schema))
    assert sorted(map(tuple, ranking.best_per_key(tied, ["k"], ["s"], ["id"], ["t"]).collect())) == [("a", 1, 5, "c"), ("b", 9, None, "n")]


@pytest.mark.parametrize("radius", [1, 100, 700, 5000, 13000])
def test_tiles_rank_all_pairs(spark, monkeypatch, radius):
    """Points at the poles, at the date line and twice at one place; tiles cut into parts, parts into batches."""
    monkeypatch.setattr(tiles, "PART_PRODUCT", 500)
    a, b = points(1, 150), points(2, 120)
    a, b = dict(enumerate(a + a[20:40])), dict(enumerate(b + b[30:50]))
    left = spark.createDataFrame([(i, *p) for i, p in a.items()] + [(-1, None, 0.0), (None, 1.0, 1.0)], "a long, alat double, alon double")
    right = spark.createDataFrame([(j, *p) for j, p in b.items()] + [(-1, 0.0, None), (None, 1.0, 1.0)], "b long, blat double, blon double")
    sides = {"a_id": "a", "a_lat": "alat", "a_lon": "alon", "b_id": "b", "b_lat": "blat", "b_lon": "blon", "miles": radius}
    got, by_shuffles = (
        proximity.proximity_match(left, right, **sides, a_rank="ra", b_rank="rb", **options).select("a", "b", "ra", "rb").collect()
        for options in ({}, {"broadcast_rows": 0, "node_rows": 3})
    )
    assert got == by_shuffles
    assert {(r["a"], r["b"]) for r in got} == {(i, j) for i, p in a.items() for j, q in b.items() if miles(p, q) <= radius}


def test_packed_pairs_keep_their_points():
    """A part's pairs are held in batches; each point's partners come out by number within a batch."""
    rank, right = tiles._rank_near(100), {"_b_no": [2, 1, 3], "_blat": [0.0, 0.1, 60.0], "_blon": [79.0, 79.1, 0.0]}
    left = {"_a_no": [7, 5, 6], "_lat": [0.0, 0.0, 0.2], "_lon": [79.0, 79.0, 78.9]}
    got = rank(pa.table(left), pa.table(right)).to_pylist()
    assert {r["_a_no"]: (r["_b_nos"], r["_b_ranks"]) for r in got} == {5: ([1, 2], [1, 1]), 6: ([1, 2], [3, 3]), 7: ([1, 2], [2, 2])}


def test_pairs_move_once(spark):
    """Where ids do not repeat, the plan has one exchange of pairs: the window and the order need none."""
    a = spark.range(300).select(F.col("id").alias("a"), (F.col("id") % 9 / 10).alias("alat"), (F.col("id") % 7 / 10).alias("alon"))
    b = a.limit(50).toDF("b", "blat", "blon")
    got = proximity.proximity_match(a, b, a_id="a", a_lat="alat", a_lon="alon", b_id="b", b_lat="blat", b_lon="blon", miles=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("FlatMapCoGroupsInArrow")]
    assert after.count("Exchange rangepartitioning") == 1 and after.count("Exchange hashpartitioning") == 0
    repeated = proximity.proximity_match(a.unionAll(a), b, a_id="a", a_lat="alat", a_lon="alon", b_id="b", b_lat="blat", b_lon="blon", miles=20)
    assert repeated.count() == 4 * got.count()
