"""Points and the one projection the landed feeds need."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: sphere radius in metres of the web map projection (EPSG:3857).
EARTH_RADIUS_M = 6378137.0


def point(lon: Column, lat: Column) -> Column:
    """``struct<lon,lat>``, null when either part is null."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def mercator_lon(x: Column) -> Column:
    """Degrees east from projected metres."""
    return F.degrees(x / F.lit(EARTH_RADIUS_M))


def mercator_lat(y: Column) -> Column:
    """Degrees north from projected metres."""
    return F.degrees(2 * F.atan(F.exp(y / F.lit(EARTH_RADIUS_M))) - F.lit(math.pi / 2))
