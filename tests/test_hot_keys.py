"""Keys cut into slices give the rows that one window per key gives."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackline.operators import feed, resample, slices, tracks
from trackline.plans.views import Inputs
from trackline.session import materialized


@pytest.fixture(scope="module")
def points(spark, sf_dir):
    """Entity 0 holds most rows, at uneven times; the others are small."""
    points = Inputs(spark, sf_dir).points()
    one = points.withColumn("entity", F.when(F.col("id") % 4 > 0, 0).otherwise(F.col("entity") + 1))
    stretched = F.when(F.col("entity") == 0, F.pow((F.col("t") - 1704067200) / 1000, 2))
    return materialized(
        one.withColumn("t", F.coalesce(stretched, F.col("t")) + F.col("id") / 1000)
    )


@pytest.fixture(scope="module")
def hot(points):
    return materialized(slices.hot_keys(points, ["entity"], "t", row_budget=60))


@pytest.fixture(scope="module")
def segments(points):
    return materialized(tracks.segment_tracks(points, gap_seconds=86400))


def test_the_large_entity_is_cut(points, hot):
    cold, sliced = slices.split_hot(points, "t", hot)
    assert cold.count() + sliced.count() == points.count()
    assert sliced.select("entity").distinct().count() >= 1
    sizes = sliced.filter("entity = 0").groupBy(slices.SLICE).count()
    n, most = sizes.agg(F.sum("count"), F.max("count")).first()
    assert sizes.count() > 10
    assert n > 700 and most <= 60


def test_a_burst_is_cut(spark):
    """All rows of a key at one time, and some before and after it."""
    times = F.when(F.col("id") < 50, F.col("id")).when(F.col("id") < 1050, 100).otherwise(F.col("id"))
    points = spark.range(1100).select(
        "id", F.lit(1).alias("entity"), times.cast("double").alias("t"), (F.col("id") * 0.001).alias("lon"),
        F.lit(2.0).alias("lat"), F.lit(3.0).alias("alt"),
    )
    cut = materialized(slices.hot_keys(points, ["entity"], "t", row_budget=100))
    _, sliced = slices.split_hot(points, "t", cut)
    assert sliced.groupBy(slices.SLICE).count().agg(F.max("count")).first()[0] <= 100
    plain = tracks.segment_tracks(points, gap_seconds=20)
    assert rows(plain) == rows(tracks.segment_tracks(points, gap_seconds=20, hot=cut))


@pytest.mark.parametrize("align", ["own", "shifted"])
def test_segments(points, hot, align):
    plain = tracks.segment_tracks(points, gap_seconds=86400, align=align)
    cut = tracks.segment_tracks(points, gap_seconds=86400, align=align, hot=hot)
    assert rows(plain) == rows(cut)
    assert plain.filter("entity = 0").agg(F.max("seg")).first()[0] > 5


def test_quality(segments, points, hot):
    one = segments.withColumn("seg", F.lit(0))
    plain = tracks.track_quality(one, min_points=8)
    assert rows(plain) == rows(tracks.track_quality(one, min_points=8, hot=hot))


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_packed_tracks(segments, hot, block_rows):
    plain = tracks.collect_tracks(segments, block_rows=block_rows)
    cut = tracks.collect_tracks(segments, block_rows=block_rows, hot=hot)
    assert rows(plain) == rows(cut)
    assert cut.agg(F.max(F.size("points"))).first()[0] <= block_rows
    back = tracks.explode_tracks(cut).drop("block")
    assert rows(back) == rows(segments.select(back.columns))


def test_fill_and_interpolation(segments):
    one = segments.withColumn("seg", F.lit(0))
    ticks = materialized(resample.time_bucket(one, step=3600))
    cut = materialized(slices.hot_keys(ticks, ["entity"], "tick", row_budget=60))
    assert rows(resample.interpolate(ticks)) == rows(resample.interpolate(ticks, hot=cut))
    plain = resample.fill_gaps(ticks)
    assert rows(plain) == rows(resample.fill_gaps(ticks, hot=cut))


def test_pairs(points, hot):
    coded = points.select(
        "entity",
        "t",
        F.col("id").cast("string").alias("raw"),
        (F.col("id") % 2).alias("odd"),
        F.col("lat").alias("y"),
        F.col("lon").alias("x"),
        "alt",
    )
    plain = feed.pair_latest(coded, max_seconds=1e9)
    assert plain.count() > 500
    assert rows(plain) == rows(feed.pair_latest(coded, max_seconds=1e9, hot=hot))


def test_a_burst_of_messages_is_cut_by_its_text(spark):
    """One entity, one time: all messages would be in one slice."""
    raw = F.concat(F.lit("8dabcdef"), F.lpad(F.hex(F.col("id") * 7919), 14, "0"), F.lit("ffffff"))
    coded = spark.range(4000).select(
        F.lit("abcdef").alias("entity"), F.lit(5.0).alias("t"), F.lower(raw).alias("raw"), (F.col("id") % 2).alias("odd"),
        F.col("id").alias("y"), F.col("id").alias("x"), F.lit(0.0).alias("alt"),
    )
    numbered = coded.withColumn("_number", feed._text_number("raw"))
    cut = materialized(slices.hot_keys(numbered, ["entity"], "t", row_budget=300, tie="_number"))
    _, sliced = slices.split_hot(numbered, "t", cut, tie="_number")
    largest = sliced.groupBy(slices.SLICE).count().agg(F.max("count")).first()[0]
    assert sliced.count() == 4000 and largest <= 300
    assert rows(feed.pair_latest(coded)) == rows(feed.pair_latest(coded, hot=cut))


def test_partitioning_does_not_matter(points, segments):
    again = tracks.segment_tracks(points.repartition(5), gap_seconds=86400)
    assert rows(segments) == rows(again)
