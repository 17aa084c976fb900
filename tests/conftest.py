from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierflow.session import HOT_GROUP_ROWS_KEY, build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Treats every group of more than three rows as hot."""
    spark.conf.set(HOT_GROUP_ROWS_KEY, "3")
    yield spark
    spark.conf.unset(HOT_GROUP_ROWS_KEY)


def rows(df):
    """Rows in a comparable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
