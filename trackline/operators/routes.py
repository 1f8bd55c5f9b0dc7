"""Routes: the ordered pair of places a trip starts and ends at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.operators.nearest import nearest_places

ROUTE = ("start", "end")


def place_filter(
    places: DataFrame,
    *,
    without_kinds: Sequence[str] = ("closed", "heliport"),
    continent: str | None = "EU",
    without_countries: Sequence[str] = (),
) -> DataFrame:
    """Places of use as trip ends: not of some kinds, on one continent, outside some countries."""
    kept = places.filter(~F.col("kind").isin(*without_kinds))
    if continent is not None:
        kept = kept.filter(F.col("continent") == continent)
    if without_countries:
        kept = kept.filter(~F.col("country").isin(*without_countries))
    return kept


def route_endpoints(
    trips: DataFrame,
    places: DataFrame,
    *,
    start: tuple[str, str] = ("start_lat", "start_lon"),
    end: tuple[str, str] = ("end_lat", "end_lon"),
) -> DataFrame:
    """Add the nearest place to either end of a trip, as ``start_place_*`` and ``end_place_*``."""
    return nearest_places(trips, places, {"start_place": start, "end_place": end})


def route_share(
    trips: DataFrame, *, route: Sequence[str] = ROUTE, label: str = "type"
) -> DataFrame:
    """Labelled trips, all trips and their ratio per route; routes without a label are left out."""
    return (
        trips.groupBy(*route)
        .agg(F.sum(label).alias("labelled"), F.count(label).alias("trips"))
        .filter(F.col("labelled") != 0)
        .withColumn("share", F.col("labelled") / F.col("trips"))
    )


def routes_with_label(
    trips: DataFrame, *, route: Sequence[str] = ROUTE, label: str = "type"
) -> DataFrame:
    """All trips on the routes that have at least one labelled trip.

    The sum per route is an aggregate and a semi-join, not a window over the route: a busy
    route is summed where its rows are, and never sorted in one task.
    """
    labelled = trips.groupBy(*route).agg(F.sum(label).alias("_sum")).filter(F.col("_sum") != 0)
    return trips.join(labelled.select(*route), list(route), "left_semi")


def adjacency(trips: DataFrame, *, route: Sequence[str] = ROUTE) -> DataFrame:
    """Per place: trips that start or end there, and where its trips go with their number.

    ``imports`` holds one entry per target place, so it cannot grow beyond the places.
    """
    start, end = route
    legs = trips.groupBy(start, end).agg(F.count(F.lit(1)).alias("trips"))
    size = (
        legs.select(F.explode(F.array(start, end)).alias("name"), "trips")
        .groupBy("name")
        .agg(F.sum("trips").alias("size"))
    )
    targets = legs.groupBy(F.col(start).alias("name")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(end).alias("name"), "trips"))).alias("imports")
    )
    return size.join(targets, "name", "left")


def place_sets(
    trips: DataFrame, *, route: Sequence[str] = ROUTE, label: str = "type"
) -> DataFrame:
    """Every place once, and whether a labelled trip starts or ends there."""
    return (
        trips.groupBy(*route)
        .agg(F.max(label).alias("_label"))
        .select(F.explode(F.array(*route)).alias("name"), "_label")
        .groupBy("name")
        .agg((F.max(F.coalesce("_label", F.lit(0))) == 1).alias("labelled"))
    )
