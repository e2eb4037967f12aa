"""Great-circle distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres.
EARTH_RADIUS_M = 6371000.0

_RADIANS_PER_DEGREE = math.pi / 180


def _radians(degrees: Column) -> Column:
    return degrees * F.lit(_RADIANS_PER_DEGREE)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in whole metres (ties to even) between two points given in degrees; null when a
    coordinate is missing."""
    half_dlat = _radians(lat2 - lat1) / 2
    half_dlon = _radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(_radians(lat1)) * F.cos(_radians(lat2)) * F.pow(
        F.sin(half_dlon), 2
    )
    bounded = F.when(chord > 1.0, 1.0).otherwise(chord)  # rounding may exceed 1 at antipodes
    return F.bround(F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(bounded)), 0)
