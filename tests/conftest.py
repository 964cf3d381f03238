from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="logengine-test-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("logengine-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "wh"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="logengine-run-")


def log_frame(spark, lines, start_ms=1484337436366, step_ms=1000):
    """Hand-made log rows in the logtopic schema."""
    from pyspark.sql import functions as F

    rows = [(i, start_ms + i * step_ms, v) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "off long, ms long, value string").select(
        "off", F.timestamp_millis("ms").alias("record_ts"), "value"
    )
