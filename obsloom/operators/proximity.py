"""Pairs of points within a distance, ranked from both sides.

Points are binned into latitude bands as high as the radius, and each band into longitude
cells at least as wide as the radius is there. Partners can only be in the neighbouring cells,
so one side is repeated into those and the pairs come from an equi-join on band and cell,
followed by the exact distance test. Where the repeated side is too large to broadcast, cells with
many points are divided further (``quadtree``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.functions.geo import haversine_miles
from obsloom.functions.keys import surrogate_key
from obsloom.operators.grid import Grid
from obsloom.operators.quadtree import NODE_ROWS, divided
from obsloom.operators.ranking import rank_within, row_id
from obsloom.operators.skew import BROADCAST_ROWS, at_most, lookup_join
from obsloom.operators.tiles import apart, near_ranked
from obsloom.session import materialise

#: A side that is looked up by number may have this many times the rows of other broadcasts, within the same bytes.
LOOKED_UP = 20
#: Pairs that a task sorts with the attributes of one side.
SORTED_PAIRS = 250_000


def distance_join(
    a: DataFrame,
    b: DataFrame,
    *,
    a_id: str,
    a_lat: str,
    a_lon: str,
    b_id: str,
    b_lat: str,
    b_lon: str,
    miles: float,
    distance_as: str = "distance_miles",
    broadcast_rows: int = BROADCAST_ROWS,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """All pairs (``a_id``, ``b_id``) within ``miles``; ``b`` should be the smaller side.

    Beyond ``broadcast_rows`` repeated rows of ``b``, no task compares more than about ``node_rows``
    rows of either side, however dense a cell is.
    """
    grid = Grid(miles)
    placed = (
        a.select(F.col(a_id), F.col(a_lat).cast("double").alias("_lat"), F.col(a_lon).cast("double").alias("_lon"))
        .dropna()
        .withColumn("_band", grid.band(F.col("_lat")))
        .withColumn("_cell", grid.cell(F.col("_lon"), grid.cells(F.col("_band"))))
    )
    probes = (
        b.select(F.col(b_id), F.col(b_lat).cast("double").alias("_blat"), F.col(b_lon).cast("double").alias("_blon"))
        .dropna()
    )
    probes = grid.reaching(probes, "_blat", "_blon")
    if at_most(probes, broadcast_rows):
        pairs = placed.join(F.broadcast(probes), ["_band", "_cell"])
    else:
        cells = grid.cells(F.col("_band"))
        places = placed.withColumn("_up", (F.col("_lat") + 90) / F.lit(grid.height) - F.col("_band"))
        places = places.withColumn("_along", grid.around(F.col("_lon"), cells) - F.col("_cell"))
        left, right, node = divided(places, probes, a_id=a_id, b_id=b_id, angle=grid.angle, node_rows=node_rows)
        pairs = left.join(right, node)
    return pairs.select(
        a_id, b_id, haversine_miles("_lat", "_lon", "_blat", "_blon").alias(distance_as)
    ).filter(F.col(distance_as) <= miles)


def proximity_match(
    a: DataFrame,
    b: DataFrame,
    *,
    a_id: str,
    a_lat: str,
    a_lon: str,
    b_id: str,
    b_lat: str,
    b_lon: str,
    miles: float = 100,
    key_name: str = "station_city_match_id",
    a_rank: str = "station_to_city_proximity_rank",
    b_rank: str = "city_to_station_proximity_rank",
    ordered: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """Pairs within ``miles`` with all attributes of both sides and the rank of each for the other.

    Where ``b`` can be broadcast and no id repeats, pairs are made and ranked for ``b`` in tiles, and move once, as
    partners' bits and ranks, to where they are ranked for ``a`` and meet its attributes (``tiles``). Ranks for ``b``
    go by distances that may differ from the given ones by rounding. With ``broadcast_rows=0`` no points are broadcast to make pairs: these
    move as numbers, for each rank once, and meet the attributes of ``a`` as before. Otherwise narrow pairs
    are shuffled for each rank and attributes are looked up afterwards.
    ``a`` and ``b`` must share no column name. Rows come by ``a_id`` and rank if ``ordered``.
    """
    limits = {"broadcast_rows": broadcast_rows, "node_rows": node_rows}
    places = {"a_id": a_id, "a_lat": a_lat, "a_lon": a_lon, "b_id": b_id, "b_lat": b_lat, "b_lon": b_lon, "miles": miles}
    numbered = at_most(b, LOOKED_UP * (broadcast_rows or BROADCAST_ROWS)) and not _repeats(a, a_id) and not _repeats(b, b_id)
    if numbered:
        form = _ranked_by_numbers(a, b, **places, a_rank=a_rank, b_rank=b_rank, **limits)
    else:
        form = _ranked_by_shuffles(a, b, **places, a_rank=a_rank, b_rank=b_rank, **limits)
    result = form.select(
        surrogate_key([a_id, b_id]).alias(key_name), *a.columns, *b.columns, "distance_miles", a_rank, b_rank
    )
    return result.orderBy(a_id, a_rank) if ordered and not numbered else result


def _repeats(df: DataFrame, key: str) -> bool:
    return not df.groupBy(key).agg(F.count(key).alias("_n")).filter("_n > 1").isEmpty()


def _ranked_by_shuffles(a: DataFrame, b: DataFrame, *, a_id: str, b_id: str, a_rank: str, b_rank: str, **places) -> DataFrame:
    pairs = materialise(distance_join(a, b, a_id=a_id, b_id=b_id, **places))
    nearest = F.col("distance_miles").asc()
    ranked = rank_within(pairs, [a_id], [nearest, F.col(b_id).asc()], a_rank)
    ranked = rank_within(ranked, [b_id], [nearest, F.col(a_id).asc()], b_rank)
    wide = lookup_join(ranked, a, [a_id], "inner", spread=[b_id])
    return lookup_join(wide, b, [b_id], "inner", spread=[a_id])


def _ranked_by_numbers(
    a: DataFrame, b: DataFrame, *, a_id: str, a_lat: str, a_lon: str, b_id: str, b_lat: str, b_lon: str, miles: float, a_rank: str, b_rank: str,
    broadcast_rows: int, node_rows: int,
) -> DataFrame:
    """Pairs in the order of ``a_id`` and rank. Rows without an id or a place take no part."""
    # Numbers in the order of the ids stand for them in ranks.
    a_rows = row_id(a.dropna(subset=[a_id, a_lat, a_lon]), [F.col(a_id).asc()], "_a_no")
    b_rows = row_id(b.dropna(subset=[b_id, b_lat, b_lon]), [F.col(b_id).asc()], "_b_no")
    b_rows = b_rows.withColumn("_b_no", F.col("_b_no").cast("int"))
    points = a_rows.select("_a_no", F.col(a_lat).cast("double").alias("_lat"), F.col(a_lon).cast("double").alias("_lon"))
    probes = b_rows.select("_b_no", F.col(b_lat).cast("double").alias("_blat"), F.col(b_lon).cast("double").alias("_blon"))
    if broadcast_rows:
        moved, probes, pairs = near_ranked(points, probes, miles)
    else:
        moved, pairs = _ranked_in_pieces(points, probes, miles, node_rows)

    # The attributes of a point travel once, beside its pairs.
    own = a_rows.select("_a_no", F.struct(*a.columns).alias("_row"))
    together = moved.withColumn("_own", F.lit(False)).unionByName(own.withColumn("_own", F.lit(True)), allowMissingColumns=True)
    tasks = max(a.sparkSession.sparkContext.defaultParallelism, pairs // SORTED_PAIRS)
    placed = together.repartitionByRange(tasks, "_a_no")
    row_first = W.partitionBy("_a_no").orderBy(F.col("_row").isNull())
    placed = placed.withColumn("_row", F.first("_row").over(row_first)).filter("NOT _own")
    by, placed = ("_b_at", apart(placed, "_a_no", "_row")) if broadcast_rows else ("_b_no", placed.select("_a_no", "_row", "_b_no", "_b_rank"))

    distance = haversine_miles(F.col("_row")[a_lat].cast("double"), F.col("_row")[a_lon].cast("double"), "_blat", "_blon")
    near = placed.join(F.broadcast(probes), by).withColumn("distance_miles", distance).drop("_b_at", "_blat", "_blon")
    near = near.filter(F.col("distance_miles") <= miles)
    nearest = W.partitionBy("_a_no").orderBy(F.col("distance_miles").asc(), F.col("_b_no").asc())
    ranked = near.withColumn(a_rank, F.row_number().over(nearest).cast("bigint"))
    wide = ranked.join(F.broadcast(b_rows), "_b_no")
    return wide.select(
        *[F.col("_row")[c].alias(c) for c in a.columns], *b.columns, "distance_miles", a_rank, F.col("_b_rank").cast("bigint").alias(b_rank)
    )


def _ranked_in_pieces(points: DataFrame, probes: DataFrame, miles: float, node_rows: int) -> tuple[DataFrame, int]:
    """Pairs of numbers, made without a broadcast of points, with the first side's rank for the second; and how many there are.

    Pairs are made twice, first for the sizes of their groups, rather than stored.
    """
    sides = {"a_id": "_a_no", "a_lat": "_lat", "a_lon": "_lon", "b_id": "_b_no", "b_lat": "_blat", "b_lon": "_blon"}
    pairs = distance_join(points, probes, **sides, miles=miles, broadcast_rows=0, node_rows=node_rows)
    sizes = pairs.groupBy("_b_no").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("most"), F.sum("_n").alias("all")).first()
    nearest = [F.col("distance_miles").asc(), F.col("_a_no").asc()]
    ranked = rank_within(pairs, ["_b_no"], nearest, "_b_rank", largest=sizes["most"] or 0)
    return ranked.select("_a_no", "_b_no", "_b_rank"), int(sizes["all"] or 0)
