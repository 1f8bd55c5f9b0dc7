"""Queries that go through stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.plans.registry import query
from trackline.plans.reports import MIDDLE
from trackline.plans.resample import STEP, airline_types, ticks
from trackline.plans.routes import journey_routes, medoids
from trackline.plans.views import Inputs
from trackline.operators import medoid, report, resample
from trackline.session import materialized, scratch_dir
from trackline.sources import stores


@query(
    "trip_store",
    """SELECT r.entity, r.seg, start, "end", type, airline, n, total IS NOT NULL AS main
       FROM journey_routes r
       JOIN (SELECT entity, seg, count(*) AS n FROM journeys GROUP BY entity, seg) USING (entity, seg)
       LEFT JOIN airlines USING (entity)
       LEFT JOIN (SELECT entity, seg, total FROM medoids) USING (entity, seg)""",
    "journeys journey_routes airlines medoids",
)
def _trip_store(i: Inputs) -> DataFrame:
    """Everything known about a trip, from tables that are bucketed alike."""
    folder, keys = scratch_dir(i.spark), ["entity", "seg"]

    def stored(name: str, df: DataFrame) -> DataFrame:
        return stores.write_bucketed(df, f"{folder}/{name}", buckets=8)

    trips = stored("routes", journey_routes(i))
    sizes = stored("sizes", i.journeys().groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    main = stored("main", medoids(i).select(*keys, F.lit(True).alias("main")))
    joined = trips.join(sizes, keys).join(main, keys, "left").na.fill(False, ["main"])
    return joined.join(i.airlines(), "entity", "left")


@query(
    "trip_store_points",
    "SELECT id, entity, seg, lon, lat, alt FROM journeys JOIN medoids USING (entity, seg)",
    "journeys medoids",
)
def _trip_store_points(i: Inputs) -> DataFrame:
    """The points of the main trips, both sides from a store."""
    folder = scratch_dir(i.spark)
    points = stores.write_bucketed(i.journeys(), f"{folder}/points", buckets=8)
    main = medoids(i).select("entity", "seg")
    chosen = stores.write_bucketed(main, f"{folder}/main", buckets=8)
    return medoid.medoid_points(points, chosen).drop("t")


@query("snapshot_store", f"SELECT * FROM resampled WHERE floor(t) = {MIDDLE}", "resampled")
def _snapshot_store(i: Inputs) -> DataFrame:
    """One second of the resampled points, from a store cut by days."""
    path, day = f"{scratch_dir(i.spark)}/points", 86_400
    every = resample.resampled_labelled(
        materialized(ticks(i)), i.airlines(), airline_types(i), step=STEP
    )
    stores.write_time_slices(every, path, seconds=day, parts=2)
    return report.snapshot(stores.read_between(i.spark, path, MIDDLE, MIDDLE + 1, seconds=day), MIDDLE)
