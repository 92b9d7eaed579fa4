import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set library or session settings for one test."""
    names = []

    def put(name, value):
        names.append(name)
        spark.conf.set(name, str(value))

    yield put
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def no_broadcast(setting):
    """Send every keyed join down the shuffled way, with only the hot keys joined by broadcast."""
    setting("spark.ledgerloom.broadcastBytes", 0)


@pytest.fixture(scope="session")
def folder():
    return SMALL


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
