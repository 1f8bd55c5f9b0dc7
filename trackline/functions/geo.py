"""Geometry on the sphere as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6378.137


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between two points given in degrees."""
    half_dlat = F.radians(lat1 - lat2) / 2
    half_dlon = F.radians(lon1 - lon2) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    # Rounding can push antipodal points a hair above 1, where asin is NaN.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def unit_vector(lat: Column, lon: Column) -> dict[str, Column]:
    """Position on the unit sphere; it has no seam at the poles or the date line."""
    return {
        "x": F.cos(F.radians(lat)) * F.cos(F.radians(lon)),
        "y": F.cos(F.radians(lat)) * F.sin(F.radians(lon)),
        "z": F.sin(F.radians(lat)),
    }
