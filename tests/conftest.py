from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests are local: set our own checkpoint folder only because none is set
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="idbridge-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch() -> str:
    return tempfile.mkdtemp(prefix="idbridge-test-")


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
