"""Dividing dense grid cells, so that a distance join compares bounded pieces.

A cell with more than ``NODE_ROWS`` points is cut into four, again and again, down to
``DEPTH`` levels. Counts per smallest square decide that, not the points themselves. Each
piece keeps the box its points lie in, and a probe is sent only to pieces whose box is within
reach. Points too close together to be parted, and pieces that very many probes reach, are cut into
blocks by a hash of the id; every block of one side meets every block of the other once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.operators.grid import within_reach
from obsloom.operators.skew import lookup_join
from obsloom.session import materialise

NODE_ROWS = 8_192
DEPTH = 12
_CELL = ["_band", "_cell"]
_SMALLEST = [*_CELL, "_y", "_x"]
_NODE = [*_CELL, "_level", "_ny", "_nx"]
_BOX = ["_south", "_north", "_west", "_east"]


def _square(part: str) -> Column:
    """The number of the smallest square that a fraction of a cell falls into."""
    side = 1 << DEPTH
    return F.least(F.greatest(F.floor(F.col(part) * side), F.lit(0)), F.lit(side - 1)).cast("int")


def _node() -> list[Column]:
    """The square of level ``_level`` around a smallest square."""
    up = F.lit(DEPTH) - F.col("_level")
    side = F.pow(F.lit(2.0), up)
    return [F.floor(F.col("_y") / side).cast("int").alias("_ny"), F.floor(F.col("_x") / side).cast("int").alias("_nx")]


def _levels(smallest: DataFrame, node_rows: int) -> DataFrame:
    """Each smallest square with the level of the piece it belongs to."""
    in_cell = smallest.groupBy(*_CELL).agg(F.sum("_n").alias("_in_cell"))
    dense = smallest.join(in_cell.filter(F.col("_in_cell") > node_rows), _CELL).drop("_in_cell")
    at_levels = dense.select(*_SMALLEST, "_n", F.explode(F.sequence(F.lit(1), F.lit(DEPTH))).alias("_level"))
    at_levels = at_levels.select(*_SMALLEST, "_n", "_level", *_node())
    small = at_levels.groupBy(*_NODE).agg(F.sum("_n").alias("_in_node"))
    small = small.filter((F.col("_in_node") <= node_rows) | (F.col("_level") == DEPTH)).select(*_NODE)
    first = at_levels.join(small, _NODE).groupBy(*_SMALLEST).agg(F.min("_level").alias("_level"))
    return smallest.join(first, _SMALLEST, "left").withColumn("_level", F.coalesce("_level", F.lit(0)))


def divided(
    placed: DataFrame, probes: DataFrame, *, a_id: str, b_id: str, angle: float, node_rows: int = NODE_ROWS
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the columns to join them on.

    ``placed`` has ``_lat``, ``_lon``, ``_band``, ``_cell`` and its fractions ``_up`` and ``_along`` of
    the cell; ``probes`` has ``_blat``, ``_blon`` and the cells it reaches. A pair meets at most once.
    """
    points = placed.withColumn("_y", _square("_up")).withColumn("_x", _square("_along")).drop("_up", "_along")
    lon = F.pmod(F.col("_lon") + 180, F.lit(360.0))
    smallest = points.groupBy(*_SMALLEST).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_lat").alias("_south"), F.max("_lat").alias("_north"), F.min(lon).alias("_west"), F.max(lon).alias("_east"),
    )
    squares = materialise(_levels(materialise(smallest), node_rows).select("*", *_node()))
    nodes = squares.groupBy(*_NODE).agg(
        F.sum("_n").alias("_n"),
        F.min("_south").alias("_south"), F.max("_north").alias("_north"), F.min("_west").alias("_west"), F.max("_east").alias("_east"),
    )
    reached = lookup_join(probes, nodes, _CELL, "inner", spread=[b_id]).filter(within_reach(angle, "_blat", "_blon")).drop(*_BOX)
    reached = materialise(reached)
    blocks = reached.groupBy(*_NODE).agg(
        F.ceil(F.max("_n") / node_rows).cast("int").alias("_ia"), F.ceil(F.count(F.lit(1)) / node_rows).cast("int").alias("_ib")
    )
    # Pieces that no probe reaches are left out here, before their points are joined with anything.
    wanted = squares.drop("_n", *_BOX).join(blocks, _NODE)
    left = lookup_join(points, wanted, _SMALLEST, "inner", spread=[a_id])
    left = left.withColumn("_i", F.pmod(F.xxhash64(a_id), F.col("_ia")).cast("int"))
    left = left.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_ib") - 1)))
    right = lookup_join(reached.drop("_n"), blocks, _NODE, "inner", spread=[b_id])
    right = right.withColumn("_j", F.pmod(F.xxhash64(b_id), F.col("_ib")).cast("int"))
    right = right.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_ia") - 1)))
    keys = [*_NODE, "_i", "_j"]
    return left.select(a_id, "_lat", "_lon", *keys), right.select(b_id, "_blat", "_blon", *keys), keys
