"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in miles.
EARTH_RADIUS_MILES = 3959


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Distance in miles between two points given in degrees."""
    lat1, lon1, lat2, lon2 = (F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
