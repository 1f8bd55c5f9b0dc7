"""Tables for many later reads: plans without shuffles, slices that are not read."""

import glob
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackline.operators import report, ranking
from trackline.sources import stores


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_meet_without_shuffles(spark, shared, no_broadcast):
    trips = spark.range(500).select((F.col("id") % 60).alias("entity"), (F.col("id") % 7).alias("seg"), "id").dropDuplicates(["entity", "seg"])
    sizes = trips.select("entity", "seg", (F.col("id") * 2).alias("n")).filter("n % 3 = 0")
    one = stores.write_bucketed(trips, f"{shared}/trips", buckets=4)
    other = stores.write_bucketed(sizes, f"{shared}/sizes", buckets=4)
    joined = one.join(other, ["entity", "seg"])
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert rows(joined) == rows(trips.join(sizes, ["entity", "seg"])) and joined.count() > 50
    # semi-joins and aggregates on the key do without a shuffle too
    assert "Exchange" not in plan(one.join(other, ["entity", "seg"], "left_semi"))
    assert "Exchange" not in plan(one.groupBy("entity", "seg").count())
    # a side that is not stored is shuffled alone
    assert plan(one.join(sizes, ["entity", "seg"])).count("Exchange hashpartitioning") == 1

    again = stores.open_bucketed(spark, f"{shared}/trips", one.schema, buckets=4)
    assert rows(again) == rows(trips)
    assert "Exchange" not in plan(again.join(other, ["entity", "seg"]))


def test_time_slices_are_pruned(spark, shared):
    points = spark.range(2000).select(
        (F.col("id") % 9).alias("entity"), (F.col("id") * 37.5 - 900).alias("t"), F.col("id").alias("lon")
    )
    path = f"{shared}/slices"
    stores.write_time_slices(points, path, seconds=3600, parts=3)
    folder = path.removeprefix("file:")
    assert len(glob.glob(f"{folder}/slice=*")) == 22 and len(glob.glob(f"{folder}/slice=2/*.parquet")) <= 3
    second = report.snapshot(stores.read_between(spark, path, 7500, 7501), 7500)
    assert "PartitionFilters: [isnotnull(slice" in plan(second)
    read = stores.read_between(spark, path, 7500, 7501)
    assert {f.split("slice=")[1].split("/")[0] for f in read.inputFiles()} >= {"2"}
    assert rows(second) == rows(report.snapshot(points, 7500)) and second.count() == 1
    for first, last in ((-900, -900), (3599, 3700), (0, 80_000)):
        got = stores.read_between(spark, path, first, last)
        assert rows(got) == rows(points.filter(F.col("t").between(first, last)))


def test_volumes_at_many_times(spark):
    rng = random.Random(1)
    events = [(rng.choice("abc"), rng.choice([0, 1, None]), rng.choice([None, float(rng.randrange(100))])) for _ in range(400)]
    times = [5.0, 5.0, 0.0, 50.5, 99.0, 200.0, None]
    got = report.volume_series(
        spark.createDataFrame(events, "name string, type int, t double"), spark.createDataFrame([(x,) for x in times], "at double")
    )
    want = {}
    for at in {x for x in times if x is not None}:
        for name, label, t in events:
            if t is not None and t < at:
                want[at, name, label] = want.get((at, name, label), 0) + 1
    assert {(r.at, r.name, r.type): r.n for r in got.collect()} == want
    none = report.volume_series(spark.createDataFrame([], "name string, type int, t double"), spark.createDataFrame([], "at double"))
    assert none.count() == 0


def test_volumes_of_counted_events(spark, shared):
    """Events that are counted already give the same; no more rows are sorted than there are places, labels and times."""
    events = spark.range(3000).select((F.col("id") % 3).cast("string").alias("name"), F.lit(1).alias("type"), (F.col("id") % 40).cast("double").alias("t"))
    times = spark.range(0, 50, 7).select(F.col("id").cast("double").alias("at"))
    counted = events.groupBy("name", "type", "t").agg(F.count(F.lit(1)).alias("trips"))
    sorted_rows = []
    hot = report.slices.hot_keys

    def seen(both, *args):
        sorted_rows.append(both.count())
        return hot(both, *args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(report.slices, "hot_keys", seen)
        assert rows(report.volume_series(events, times)) == rows(report.volume_series(counted, times, n="trips"))
    assert sorted_rows == [120 + 8] * 2


def test_volumes_do_not_depend_on_slices(spark):
    from trackline.operators import slices
    from trackline.session import materialized

    events = spark.range(3000).select((F.col("id") % 5).cast("string").alias("name"), F.lit(1).alias("type"), (F.col("id") % 701).cast("double").alias("t"))
    times = spark.range(0, 800, 13).select(F.col("id").cast("double").alias("at"))
    keyed = events.select(F.lit(0).alias("_all"), F.col("t").alias("_t"))
    hot = materialized(slices.hot_keys(keyed, ["_all"], "_t", row_budget=200))
    assert hot.count() == 1
    assert rows(report.volume_series(events, times)) == rows(report.volume_series(events, times, hot=hot))


def test_sketches_merge_within_their_error(spark):
    values = spark.range(200_000).select((F.col("id") % 17).alias("day"), F.rand(3).alias("x"))
    kept = ranking.quantile_sketches(values, "x", ["day"])
    assert kept.select(F.max(F.length("sketch"))).first()[0] < 40_000
    levels = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    found = {r.level: r for r in ranking.sketch_quantiles(kept, levels).collect()}
    ordered = sorted(r.x for r in values.select("x").collect())
    for level in levels:
        at = ordered[max(int((level - ranking.SKETCH_ERROR) * 200_000), 0)], ordered[min(int((level + ranking.SKETCH_ERROR) * 200_000), 199_999)]
        assert found[level].n == 200_000 and at[0] <= found[level].value <= at[1]
    empty = values.limit(0)
    assert ranking.sketch_quantiles(ranking.quantile_sketches(empty, "x", ["day"]), levels, ["day"]).count() == 0
