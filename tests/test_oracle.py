"""Every registered query against its SQL in another engine, on the smallest data."""

import pytest

from check import connect, differences
from trackline import plans

NO_SQL = set(plans.QUERIES) - set(plans.ORACLE)


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_same_rows(spark, db, sf_dir, name):
    got = plans.QUERIES[name](spark, sf_dir).toPandas()
    assert differences(got, db.sql(plans.ORACLE[name]).df()) is None


def test_only_models_and_the_census_have_no_sql():
    assert NO_SQL == {"rf_metrics", "rf_label_fill", "model_compare", "ratio_sweep", "file_census"}
