import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from plumbline.functions.sizing import use_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    use_scratch(str(tmp_path_factory.mktemp("scratch")))
    session = (
        SparkSession.builder.master("local[8]")
        .appName("plumbline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pairs(spark):
    """Rows of a frame as a sorted list of tuples."""

    def collect(frame, *columns):
        rows = frame.select(*columns).collect() if columns else frame.collect()
        return sorted((tuple(r) for r in rows), key=repr)

    return collect
