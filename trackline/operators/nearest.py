"""Nearest place of each point, exact, without comparing all points to all places.

The sphere is laid into a 3-D grid of cubes, so poles and the date line need no special
case. Cubes with points meet cubes with places, coarse cubes first: a pair of cubes stays
while no other cube of places is sure to be nearer to all points of the first. Each cube keeps
the few cubes around its nearest ones, however many places there are, and only children of
pairs that stay are looked at. The finest cubes then get a short list of places, and the points
meet it by an equi-join on their cube, which adaptive execution splits where a cube is crowded,
and stay one row each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.functions.geo import haversine_km, unit_vector
from trackline.session import materialized

RESOLUTIONS = (2, 8, 32, 128, 512)  # cubes per Earth radius, coarse to fine; the finest is 12 km
FINEST = RESOLUTIONS[-1]
BITS = 11  # coordinates run from 0 to 2 * FINEST
ROUNDING_SLACK = 1e-9


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    *,
    lat: str = "lat",
    lon: str = "lon",
    name: str = "name",
    place_lat: str = "lat",
    place_lon: str = "lon",
    decimals: int = 2,
    prefix: str = "place",
) -> DataFrame:
    """Add ``{prefix}_name``, ``_lat``, ``_lon`` and ``_km`` of the nearest place.

    Both sides are first rounded to ``decimals`` degrees; equal distances go to the first
    name. Points without a position get nulls.
    """
    return nearest_places(
        points,
        places,
        {prefix: (lat, lon)},
        name=name,
        place_lat=place_lat,
        place_lon=place_lon,
        decimals=decimals,
    )


def nearest_places(
    rows: DataFrame,
    places: DataFrame,
    positions: dict[str, tuple[str, str]],
    *,
    name: str = "name",
    place_lat: str = "lat",
    place_lon: str = "lon",
    decimals: int = 2,
) -> DataFrame:
    """``nearest_place`` for several positions per row, ``{prefix: (lat, lon)}``.

    The candidates are worked out once for all positions, and the rows are not turned
    into one row per position and back.
    """
    spots = (
        places.select(
            F.col(name).alias("name"),
            F.round(place_lat, decimals).alias("lat"),
            F.round(place_lon, decimals).alias("lon"),
        )
        .na.drop()
        .groupBy("lat", "lon")
        .agg(F.min("name").alias("name"))
    )
    rounded = {
        prefix: (F.round(lat, decimals), F.round(lon, decimals))
        for prefix, (lat, lon) in positions.items()
    }
    cubes = rows.select(
        F.explode(F.array(*[_cube(*at) for at in rounded.values()])).alias("_cube")
    )
    index = _candidates(materialized(cubes.na.drop().distinct()), materialized(spots))
    for prefix, at in rounded.items():
        rows = _look_up(rows, index, prefix, *at)
    return rows


def _look_up(
    rows: DataFrame, index: DataFrame, prefix: str, lat: Column, lon: Column
) -> DataFrame:
    measured = F.transform(
        "_candidates",
        lambda spot: F.struct(
            haversine_km(F.col("_lat"), F.col("_lon"), spot["lat"], spot["lon"]).alias("km"),
            spot["name"].alias("name"),
            spot["lat"].alias("lat"),
            spot["lon"].alias("lon"),
        ),
    )
    return (
        rows.withColumns({"_lat": lat, "_lon": lon, "_cube": _cube(lat, lon)})
        .join(index, "_cube", "left")
        .withColumn("_best", F.array_min(measured))
        .withColumns({f"{prefix}_{f}": F.col(f"_best.{f}") for f in ("name", "lat", "lon", "km")})
        .drop("_cube", "_lat", "_lon", "_candidates", "_best")
    )


def _cube(lat: Column, lon: Column) -> Column:
    """Number of the finest cube around a position."""
    x, y, z = (F.floor((c + 1) * FINEST) for c in unit_vector(lat, lon).values())
    return _number(x, y, z)


def _number(x: Column, y: Column, z: Column) -> Column:
    return F.shiftleft(x, 2 * BITS) + F.shiftleft(y, BITS) + z


AXES = ("x", "y", "z")


def _at(cube: Column, resolution: int) -> list[Column]:
    """Coordinates of the cube of a resolution that holds a finest cube."""
    mask = F.lit((1 << BITS) - 1)
    finest = (
        F.shiftright(cube, 2 * BITS),
        F.shiftright(cube, BITS).bitwiseAND(mask),
        cube.bitwiseAND(mask),
    )
    return [F.floor(axis / (FINEST // resolution)) for axis in finest]


def _level(cubes: DataFrame, parent: int | None, resolution: int, side: str) -> DataFrame:
    """The occupied cubes of a resolution with their parents and centres."""
    here = _at(F.col("_cube"), resolution)
    above = F.lit(0).cast("bigint") if parent is None else _number(*_at(F.col("_cube"), parent))
    return cubes.select(
        above.alias(f"_{side}_parent"),
        _number(*here).alias(f"_{side}"),
        *[((c + 0.5) / resolution - 1).alias(f"_{side}_{a}") for a, c in zip(AXES, here)],
    ).distinct()


def _gap(one: str, other: str) -> Column:
    return F.sqrt(sum((F.col(f"{one}_{a}") - F.col(f"{other}_{a}")) ** 2 for a in AXES))


def _nearest_only(pairs: DataFrame, gap: Column, slack: float) -> DataFrame:
    """Pairs of a cube of points that are at most ``slack`` farther apart than its nearest one."""
    best = F.min("_gap").over(Window.partitionBy("_here"))  # few rows: the cubes around the nearest
    measured = pairs.withColumn("_gap", gap).withColumn("_best", best)
    return measured.filter(F.col("_gap") <= F.col("_best") + slack + ROUNDING_SLACK)


def _candidates(cubes: DataFrame, spots: DataFrame) -> DataFrame:
    """For each finest cube the array of places that may be nearest to a point in it."""
    spots = spots.withColumns(
        {f"_spot_{k}": v for k, v in unit_vector(F.col("lat"), F.col("lon")).items()}
    ).withColumn("_cube", _cube(F.col("lat"), F.col("lon")))
    parent, near = None, None
    for resolution in RESOLUTIONS:
        here = _level(cubes, parent, resolution, "here")
        there = _level(spots, parent, resolution, "there")
        if near is None:  # at most (2 * RESOLUTIONS[0] + 1) ** 3 cubes on either side
            pairs = here.join(there, F.col("_here_parent") == F.col("_there_parent"))
        else:
            pairs = near.join(here, "_here_parent").join(there, "_there_parent")
        # both ends lie anywhere in their cubes
        near = _nearest_only(pairs, _gap("_here", "_there"), 2 * math.sqrt(3) / resolution)
        near = near.select(
            F.col("_here").alias("_here_parent"), F.col("_there").alias("_there_parent")
        )
        parent = resolution
    finest = _level(cubes, FINEST, FINEST, "here").drop("_here_parent")
    pairs = near.select(F.col("_here_parent").alias("_here"), F.col("_there_parent").alias("_cube"))
    pairs = pairs.join(finest, "_here").join(spots, "_cube")
    kept = _nearest_only(pairs, _gap("_here", "_spot"), math.sqrt(3) / FINEST)
    return kept.groupBy(F.col("_here").alias("_cube")).agg(
        F.collect_list(F.struct("name", "lat", "lon")).alias("_candidates")
    )
