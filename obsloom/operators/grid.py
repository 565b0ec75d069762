"""Cells on the globe at least as wide as a radius, so that partners are in neighbouring cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.functions.geo import EARTH_RADIUS_MILES


class Grid:
    """Band and cell expressions for one radius. A little slack covers rounding at the edges."""

    def __init__(self, miles: float):
        self.angle = miles / EARTH_RADIUS_MILES * (1 + 1e-9) + 1e-12
        self.height = min(math.degrees(self.angle), 180.0)

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / F.lit(self.height))

    def cells(self, band: Column) -> Column:
        """Number of cells around a band, by its edge nearest to a pole."""
        low = F.abs(band * self.height - 90)
        high = F.abs((band + 1) * self.height - 90)
        edge = F.radians(F.least(F.greatest(low, high), F.lit(90.0)))
        reaches_pole = edge + self.angle >= math.pi / 2 - 1e-9
        ratio = F.when(reaches_pole, F.lit(1.0)).otherwise(F.lit(math.sin(self.angle)) / F.cos(edge))
        width = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9)
        return F.when(reaches_pole, F.lit(1)).otherwise(F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))).cast("bigint")

    def around(self, lon: Column, cells: Column) -> Column:
        """Where a longitude is on its band, in cells from the date line."""
        return F.pmod(lon + 180, F.lit(360.0)) / 360 * cells

    def cell(self, lon: Column, cells: Column) -> Column:
        return F.least(F.floor(self.around(lon, cells)), cells - 1)

    def reaching(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """Each row once per cell that can have partners of it, with that ``_band`` and ``_cell``."""
        own = self.band(F.col(lat))
        at = df.withColumn("_band", F.explode(F.sequence(own - 1, own + 1))).withColumn("_cells", self.cells(F.col("_band")))
        at = at.withColumn("_at", self.cell(F.col(lon), F.col("_cells")))
        beside = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda s: F.pmod(F.col("_at") + s, F.col("_cells")))
        return at.withColumn("_cell", F.explode(F.array_distinct(beside))).drop("_cells", "_at")

    def box(self, band: Column, cell: Column) -> dict[str, Column]:
        """The edges of a cell, a little outside; longitudes count from the date line."""
        south, width = band * F.lit(self.height) - 90, F.lit(360.0) / self.cells(band)
        return {
            "_south": south - 1e-9, "_north": south + self.height + 1e-9,
            "_west": cell * width - 1e-9, "_east": (cell + 1) * width + 1e-9,
        }


def within_reach(angle: float, lat: str, lon: str) -> Column:
    """Whether any place of a box can be within ``angle`` of a point: a lower bound of the haversine."""
    low = F.greatest(F.col("_south") - F.col(lat), F.col(lat) - F.col("_north"), F.lit(0.0))
    around = F.pmod(F.col(lon) + 180, F.lit(360.0))

    def apart(edge: str) -> Column:
        d = F.abs(around - F.col(edge))
        return F.least(d, 360 - d)

    beside = F.when(around.between(F.col("_west"), F.col("_east")), F.lit(0.0)).otherwise(F.least(apart("_west"), apart("_east")))
    narrowest = F.least(F.cos(F.radians("_south")), F.cos(F.radians("_north")))
    least = F.pow(F.sin(F.radians(low) / 2), 2) + F.cos(F.radians(lat)) * narrowest * F.pow(F.sin(F.radians(beside) / 2), 2)
    return least <= F.lit(math.sin(min(angle, math.pi) / 2) ** 2 * (1 + 1e-9) + 1e-15)
