"""Great-circle distance between two points given in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius of spherical geography types, in metres.
EARTH_RADIUS_METRES = 6_371_010.0


def great_circle_metres(lat1: Column, lng1: Column, lat2: Column, lng2: Column,
                        radius: float = EARTH_RADIUS_METRES) -> Column:
    """Haversine distance; the clamp keeps asin defined for antipodal points."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
