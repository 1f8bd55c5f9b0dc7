"""Compact position reports: two fractions per message, decoded from an even and an odd one.

The published global formula; latitude zones shrink towards the poles, and both messages
must lie in the same one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 131072  # 17 bits
ZONES = 60


def floor_mod(a: Column, b: Column) -> Column:
    return a - b * F.floor(a / b)


def longitude_zones(lat: Column) -> Column:
    """Number of longitude zones at a latitude."""
    cos = F.cos(F.radians(lat))
    inner = 1 - F.lit(1 - math.cos(math.pi / 30)) / (cos * cos)
    return (
        F.when(F.abs(lat) < 87, F.floor(F.lit(2 * math.pi) / F.acos(inner)))
        .when(F.abs(lat) == 87, 2)
        .otherwise(1)
        .cast("bigint")
    )


def latitudes(even: Column, odd: Column) -> tuple[Column, Column]:
    """Latitude at the even and at the odd message, from their latitude fractions."""
    zone = F.floor(even * (ZONES - 1) - odd * ZONES + 0.5)

    def of(fraction: Column, zones: int) -> Column:
        lat = F.lit(360.0 / zones) * (floor_mod(zone, F.lit(zones)) + fraction)
        return F.when(lat >= 270, lat - 360).otherwise(lat)

    return of(even, ZONES), of(odd, ZONES - 1)


def longitude(even: Column, odd: Column, zones: Column, is_odd: Column) -> Column:
    """Longitude at the newer message, from the longitude fractions of both."""
    m = F.floor(even * (zones - 1) - odd * zones + 0.5)
    n = F.greatest(zones - is_odd.cast("bigint"), F.lit(1))
    lon = F.lit(360.0) / n * (floor_mod(m, n) + F.when(is_odd, odd).otherwise(even))
    return F.when(lon >= 180, lon - 360).otherwise(lon)


def encoded(lat: Column, lon: Column, odd: int) -> tuple[Column, Column]:
    """The 17-bit latitude and longitude of a position in an even (0) or odd (1) message."""
    dlat = F.lit(360.0 / (ZONES - odd))
    y = F.floor(SCALE * floor_mod(lat, dlat) / dlat + 0.5)
    at = dlat * (y / SCALE + F.floor(lat / dlat))
    dlon = F.lit(360.0) / F.greatest(longitude_zones(at) - odd, F.lit(1))
    x = F.floor(SCALE * floor_mod(lon, dlon) / dlon + 0.5)
    return y % SCALE, x % SCALE
