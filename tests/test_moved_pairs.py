"""What of a pair is moved by the proximity match, and that it comes out as it was."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsloom.operators import proximity, tiles

SIDES = {"a_id": "a", "a_lat": "alat", "a_lon": "alon", "b_id": "b", "b_lat": "blat", "b_lon": "blon"}


def ranked(rows):
    lists = [pa.array([r[i] for r in rows], pa.list_(pa.field("element", pa.int32()))) for i in (1, 2)]
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), *lists], names=["_a_no", "_b_nos", "_b_ranks"])


def test_packed_partners_come_out(spark):
    """Near and far numbers, rows over several spans, ranks beyond two bytes."""
    rng = np.random.default_rng(11)
    rows = []
    for i, (span, high) in enumerate([(64, 9), (65, 65_536), (700, 65_537), (100_000, 10**6), (1, 1)] * 8):
        numbers = np.sort(rng.choice(span, min(span, 50), replace=False)) + 7 * i
        rows.append((i, numbers.tolist(), [high, *rng.integers(1, high + 1, len(numbers) - 1).tolist()]))
    rows.append((99, [5], [65_536]))
    packed = tiles.compact(pa.concat_tables([ranked(rows[:9]), ranked(rows[9:])]))
    assert packed.num_rows > len(rows)
    pairs = tiles.apart(spark.createDataFrame(packed.to_pylist(), tiles.PACKED), "_a_no")
    assert sorted(map(tuple, pairs.collect())) == sorted((i, b, rank) for i, numbers, ranks in rows for b, rank in zip(numbers, ranks))
    assert tiles.compact(ranked([])).num_rows == 0


def test_a_pair_takes_three_bytes():
    """Of 600 numbers a point has every third: two bytes for a rank, and less than one for the partner."""
    rows = [(i, list(range(i % 3, 600, 3)), [200 * i + j + 1 for j in range(200)]) for i in range(50)]
    packed = tiles.compact(ranked(rows))
    moved = sum(len(packed[c].combine_chunks().flatten()) * size for c, size in (("_bits", 8), ("_before", 2), ("_short_ranks", 2), ("_long_ranks", 4)))
    assert moved < 3 * 50 * 200


@pytest.mark.parametrize("node_rows", [16, 8_192])
def test_divided_pairs_move_as_numbers(spark, node_rows):
    """Without a broadcast of points each pair is moved for either rank once, and no wide row is sorted after that."""
    random.seed(12)
    left = [(f"station {i}", random.uniform(0, 3), random.uniform(0, 3), f"name {i}") for i in range(300)]
    right = [(f"city {i}", random.uniform(0, 3), random.uniform(0, 3), None) for i in range(80)] + [("city nowhere", None, 1.0, "x"), (None, 1.0, 1.0, "y")]
    a = spark.createDataFrame(left, "a string, alat double, alon double, aname string")
    b = spark.createDataFrame(right, "b string, blat double, blon double, bname string")
    got = proximity.proximity_match(a, b, **SIDES, miles=50, a_rank="ra", b_rank="rb", broadcast_rows=0, node_rows=node_rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning(_b_no") == 1
    assert plan.index("Exchange rangepartitioning") < plan.index("Exchange hashpartitioning")
    in_tiles = proximity.proximity_match(a, b, **SIDES, miles=50, a_rank="ra", b_rank="rb")
    rows = [tuple(r) for r in got.collect()]
    assert rows == [tuple(r) for r in in_tiles.collect()] and len(rows) > 5_00
    assert rows == sorted(rows, key=lambda r: (r[1], r[-2]))
    # Repeated ids and sides that cannot be broadcast take the general way.
    twice = proximity.proximity_match(a, b.unionAll(b.filter(F.col("b") == "city 1")), **SIDES, miles=50, a_rank="ra", b_rank="rb", broadcast_rows=0, node_rows=node_rows)
    near_city = sum(r[5] == "city 1" for r in rows)
    assert twice.count() == len(rows) + 3 * near_city
