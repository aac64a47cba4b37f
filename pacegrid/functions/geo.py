"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between two points in degrees; NULL if any part is NULL."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), F.lit(2))
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(chord))


def hop_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Like ``haversine_m`` but 0 where there is no distance to measure."""
    return F.coalesce(F.nanvl(haversine_m(lat1, lon1, lat2, lon2), F.lit(0.0)), F.lit(0.0))
