import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from trackline.session import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    """Stands in for the shared folder of a cluster."""
    return f"file:{tmp_path_factory.mktemp('shared')}"


@pytest.fixture(scope="session")
def spark(shared):
    started = session(
        "tests",
        **{
            "spark.master": "local[*]",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": shared,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    started.sparkContext.setLogLevel("ERROR")
    yield started
    started.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def rows(df):
    """Rows of a DataFrame in an order of their own."""
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
