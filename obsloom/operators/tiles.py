"""Pairs of near points with their rank for the second side, packed per point of the first.

The second side's points are dealt to tiles twice as wide as the radius, and the first side's to every
tile within the radius. A task so has all partners of its tile's points and ranks them without
another shuffle; each pair is made in one place only. Tiles with many pairs are cut into parts by the second side's
points, which are numbered part by part. What leaves a task is, for each point, which of a part's numbers are its partners,
one bit for each of them, and a rank of two bytes for each partner: two and a half to three bytes a pair where there are many.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.functions.geo import EARTH_RADIUS_MILES
from obsloom.operators.grid import Grid, within_reach
from obsloom.operators.ranking import row_id
from obsloom.session import materialise

TILE_RADII = 2
#: Points of one side times those of the other in a part of a tile; of these, up to a quarter are pairs as a rule.
PART_PRODUCT = 32_000_000
TASK_PRODUCT = 8_000_000
#: Pairs that a task holds with their distances.
_HELD = 2_000_000
_TILE = ["_band", "_cell"]
#: Partners are the bits of ``_bits``, from the number ``_base`` on; ``_before`` is how many of a row's come before each of its
#: 64 bits. Their ranks are in that order, as shorts less ``SHORT`` or as they are.
PACKED = "_a_no long, _base int, _bits array<long>, _before array<short>, _short_ranks array<short>, _long_ranks array<int>"
SHORT = 1 << 15
#: Numbers that a row reaches over.
_SPAN = 1 << 15
_INTS, _LONGS, _SHORTS = (pa.list_(pa.field("element", kind)) for kind in (pa.int32(), pa.int64(), pa.int16()))
_PACKED = pa.schema([("_a_no", pa.int64()), ("_base", pa.int32()), ("_bits", _LONGS), ("_before", _SHORTS), ("_short_ranks", _SHORTS), ("_long_ranks", _INTS)])


def _packed(a_no: np.ndarray, held: list[tuple]) -> pa.Table:
    """The held (points, partner, ranks) as one row per point."""
    at = np.concatenate([h[0] for h in held]) if held else np.empty(0, np.int64)
    partner = np.repeat(np.array([h[1] for h in held], np.int32), [len(h[0]) for h in held])
    rank = np.concatenate([h[2] for h in held]) if held else np.empty(0, np.int32)
    order = np.argsort(at, kind="stable")
    points, first = np.unique(at[order], return_index=True)
    offsets = pa.array(np.append(first, len(at)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v[order]), type=_INTS) for v in (partner, rank)]
    return pa.table([pa.array(a_no[points]), *lists], names=["_a_no", "_b_nos", "_b_ranks"])


def _rank_near(miles: float):
    """For the points of one part: everything within ``miles`` of each, nearest first and then by number.

    Pairs beyond the radius by no more than rounding are kept; they come last, so ranks do not depend on them.
    """
    limit = miles * (1 + 1e-9) + 1e-9
    angle = limit / EARTH_RADIUS_MILES + 1e-12
    high = math.degrees(angle) + 1e-9

    def widest(lat: float) -> float:
        """Degrees of longitude that points within reach can differ by."""
        if abs(lat) + high >= 90:
            return 360.0
        return math.degrees(math.asin(min(math.sin(angle) / math.cos(math.radians(lat)), 1.0))) * (1 + 1e-9) + 1e-9

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        a_no, lat, lon = (left[c].to_numpy() for c in ("_a_no", "_lat", "_lon"))
        order = np.lexsort((a_no, lon, lat))
        a_no, lat, lon = a_no[order], lat[order], lon[order]
        around, cosine = (lon + 180) % 360, np.cos(np.radians(lat))
        b_no, blat, blon = (right[c].to_numpy() for c in ("_b_no", "_blat", "_blon"))
        lows, highs = np.searchsorted(lat, blat - high, "left"), np.searchsorted(lat, blat + high, "right")
        out, held, n = [], [], 0
        for j in np.argsort(b_no):
            lo, hi = lows[j], highs[j]
            beside = np.abs(around[lo:hi] - (blon[j] + 180) % 360)
            at = lo + np.flatnonzero(np.minimum(beside, 360 - beside) <= widest(blat[j]))
            half_lat, half_lon = np.sin(np.radians(blat[j] - lat[at]) / 2), np.sin(np.radians(blon[j] - lon[at]) / 2)
            chord = half_lat * half_lat + cosine[at] * np.cos(np.radians(blat[j])) * half_lon * half_lon
            distance = 2.0 * EARTH_RADIUS_MILES * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))
            near = distance <= limit
            at, distance = at[near], distance[near]
            if not len(at):
                continue
            nearest = np.argsort(distance, kind="stable")
            sorted_d, numbers = distance[nearest], a_no[at[nearest]]
            if np.any((sorted_d[1:] == sorted_d[:-1]) & (numbers[1:] < numbers[:-1])):
                nearest = np.lexsort((a_no[at], distance))
            held.append((at[nearest], b_no[j], np.arange(1, len(at) + 1, dtype=np.int32)))
            n += len(at)
            if n >= _HELD:
                out.append(_packed(a_no, held))
                held, n = [], 0
        return pa.concat_tables([*out, _packed(a_no, held)])

    return rank


def _lists(values: np.ndarray, sizes: np.ndarray, there: np.ndarray, kind) -> pa.Array:
    """Lists of the next ``sizes`` values each, null where they are not ``there``."""
    offsets = np.append(0, np.cumsum(np.where(there, sizes, 0))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind.value_type), type=kind, mask=pa.array(~there))


def compact(ranked: pa.Table) -> pa.Table:
    """What ``_rank_near`` gives, as ``PACKED``: a row or more for each of its rows."""
    out = []
    for batch in ranked.to_batches():
        if not batch.num_rows:
            continue
        sizes = batch.column("_b_nos").value_lengths().to_numpy()
        numbers, ranks = (batch.column(c).flatten().to_numpy() for c in ("_b_nos", "_b_ranks"))
        point = np.repeat(np.arange(len(sizes)), sizes)
        span = (numbers - np.repeat(numbers[np.cumsum(sizes) - sizes], sizes)) // _SPAN
        opens = np.append(True, (point[1:] != point[:-1]) | (span[1:] != span[:-1]))
        first, row = np.flatnonzero(opens), np.cumsum(opens) - 1
        sizes, base = np.diff(np.append(first, len(numbers))), numbers[first]
        offset = numbers - base[row]
        words = offset[first + sizes - 1] // 64 + 1
        at = (np.cumsum(words) - words)[row] + offset // 64
        opens = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        bits, before = np.zeros(int(words.sum()), np.uint64), np.zeros(int(words.sum()), np.int16)
        bits[at[opens]] = np.bitwise_or.reduceat(np.uint64(1) << (offset % 64).astype(np.uint64), opens)
        before[at[opens]] = opens - first[row[opens]]
        every, short = np.ones(len(first), bool), np.maximum.reduceat(ranks, first) <= 2 * SHORT
        two_bytes = short[row]
        columns = [
            batch.column("_a_no").take(pa.array(point[first])),
            pa.array(base),
            _lists(bits.view(np.int64), words, every, _LONGS),
            _lists(before, words, every, _SHORTS),
            _lists((ranks[two_bytes] - 1 - SHORT).astype(np.int16), sizes, short, _SHORTS),
            _lists(ranks[~two_bytes], sizes, ~short, _INTS),
        ]
        out.append(pa.table(columns, schema=_PACKED))
    return pa.concat_tables(out) if out else _PACKED.empty_table()


def apart(packed: DataFrame, *keep: str) -> DataFrame:
    """The pairs of rows of ``PACKED``: ``keep``, the partner's number as ``_b_at`` and the rank as ``_b_rank``."""
    ranks = ["_before", "_short_ranks", "_long_ranks"]
    words = packed.select(*keep, "_base", *ranks, F.posexplode("_bits").alias("_nth", "_word"))
    bits = words.select("*", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_bit")).filter(F.getbit("_word", F.col("_bit")) == 1)
    lower = F.expr("shiftleft(shiftleft(_word, 63 - _bit), 1)")
    at = F.get("_before", F.col("_nth")).cast("int") + F.bit_count(lower)
    rank = F.coalesce(F.get("_short_ranks", at).cast("int") + (SHORT + 1), F.get("_long_ranks", at))
    return bits.select(*keep, (F.col("_base") + 64 * F.col("_nth") + F.col("_bit")).alias("_b_at"), rank.alias("_b_rank"))


def near_ranked(points: DataFrame, probes: DataFrame, miles: float) -> tuple[DataFrame, DataFrame, int]:
    """Rows of ``PACKED`` with a point's partners and its rank for each of them; ``probes`` with ``_b_at``, the numbers that name
    partners there; and about how many pairs there are.

    ``points`` has ``_a_no``, ``_lat`` and ``_lon``, ``probes`` has ``_b_no``, ``_blat`` and ``_blon``; the
    numbers are unique, and order what is equally far. A point may have several rows, with different partners.
    """
    spark = points.sparkSession
    grid, angle = Grid(TILE_RADII * miles), Grid(miles).angle
    home = probes.withColumn("_band", grid.band(F.col("_blat"))).withColumn("_cell", grid.cell(F.col("_blon"), grid.cells(F.col("_band"))))
    # The second side is small enough to be broadcast, and so are its tiles.
    counts = home.groupBy(*_TILE).agg(F.count(F.lit(1)).cast("double").alias("_nb"))
    held = materialise(counts.withColumns(grid.box(F.col("_band"), F.col("_cell"))))
    cores = spark.sparkContext.defaultParallelism
    around = grid.reaching(points.repartition(cores, "_a_no"), "_lat", "_lon").join(F.broadcast(held), _TILE)
    around = around.filter(within_reach(angle, "_lat", "_lon")).select("_a_no", "_lat", "_lon", *_TILE, "_nb")
    tiles = around.groupBy(*_TILE).agg(F.first("_nb").alias("_nb"), F.count(F.lit(1)).cast("double").alias("_na"))
    tiles = materialise(tiles.withColumn("_parts", F.ceil(F.least(F.col("_nb"), F.col("_nb") * F.col("_na") / PART_PRODUCT)).cast("int")))
    found = tiles.agg(F.sum("_parts").alias("parts"), F.sum(F.col("_nb") * F.col("_na")).alias("product")).first()
    parts, product = found["parts"] or 0, found["product"] or 0.0
    # Of tiles with one part nothing has to be known, and those with more are few: each stands for millions of pairs.
    cut = F.broadcast(tiles.filter("_parts > 1").select(*_TILE, "_parts"))
    home = home.join(cut, _TILE, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("_b_no"), F.col("_parts")).cast("int"), F.lit(0)))
    around = around.drop("_nb").join(cut, _TILE, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
    keys = [*_TILE, "_part"]
    # Numbers in the order of the parts are near each other where partners are.
    home = row_id(home.drop("_parts"), [F.col(c).asc() for c in (*keys, "_b_no")], "_b_at").withColumn("_b_at", F.col("_b_at").cast("int"))
    # Few bytes make many pairs, so the number of tasks goes by the pairs.
    n = max(1, min(int(parts), max(4 * cores, int(product // TASK_PRODUCT))))
    left = around.drop("_parts").repartition(n, *keys).groupBy(*keys)
    right = home.select(F.col("_b_at").alias("_b_no"), "_blat", "_blon", *keys).repartition(n, *keys).groupBy(*keys)
    rank = _rank_near(miles)
    packed = left.cogroup(right).applyInArrow(lambda a, b: compact(rank(a, b)), PACKED)
    return packed, home.select("_b_no", "_blat", "_blon", "_b_at"), int(product / 4)
