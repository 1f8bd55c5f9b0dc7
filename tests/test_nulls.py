"""Rows with nulls stay, and intermediate tables need a shared folder."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trackline import session
from trackline.operators import medoid, ranking, resample
from trackline.plans import tracks as plan
from trackline.plans.views import Inputs


def test_a_point_with_an_unknown_value_stays(spark):
    points = spark.createDataFrame(
        [(1, 0, 10, 1000.0, 1.0, 2.0, None), (1, 0, 11, 1200.0, 9.0, None, 7.0), (1, 0, 12, 4000.0, None, None, None)],
        "entity int, seg int, id int, t double, lon double, lat double, alt double",
    )
    got = resample.time_bucket(points, step=1000)
    assert rows(got.select("tick", "lon", "lat", "alt")) == rows(
        spark.createDataFrame([(1, 1.0, 2.0, 7.0), (4, None, None, None)], "tick long, lon double, lat double, alt double")
    )


def test_a_null_key_is_sampled(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert ranking.hashed_sample(df, "key", 3).count() == 3


def test_points_without_time_are_in_one_half(spark, sf_dir):
    class Some(Inputs):
        def points(self):
            return super().points().withColumn("t", F.when(F.col("id") % 3 > 0, F.col("t")))

    inputs = Some(spark, sf_dir)
    assert plan._union_days(inputs).count() == inputs.points().count()


def test_points_without_a_coordinate_pass_no_cell(spark):
    points = spark.createDataFrame(
        [(1, 0, 1, 1.0, 2.0, None), (1, 0, 2, 2.0, None, 2.0), (1, 0, 3, 3.0, 2.0, 2.0)],
        "entity int, seg int, id int, t double, lon double, lat double",
    )
    assert [r.token for r in medoid.visited_cells(points).collect()] == ["2.0,2.0"]


def test_ticks_of_one_second_only(spark):
    ticks = spark.createDataFrame(
        [(1, 0, 0, 0.0, 0.0, 0.0), (1, 0, 10, 10.0, 20.0, 30.0)],
        "entity int, seg int, tick long, lon double, lat double, alt double",
    )
    got = resample.interpolate(ticks, within=(3, 4)).select("tick", "lon", "alt").collect()
    assert sorted(map(tuple, got)) == [(3, 3.0, 9.0), (4, 4.0, 12.0)]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session())
    Context.master = "local[2]"
    assert session.scratch_dir(Session()).startswith("file:")
