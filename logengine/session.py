"""Session helpers.

Library code never creates a session behind the caller's back; it only
pins the session time zone (every text rendering of a timestamp in this
engine is UTC) and reads the checkpoint folder the cluster names.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin ``spark.sql.session.timeZone`` to UTC (log and point times are UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "logengine",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (roughly
    input bytes / 128 MB), AQE coalesces the small ones at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session without one (tests, local runs) gets a fresh
    scratch folder of its own; on a cluster the setting must point at shared
    storage, and without it this is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        base = named or tempfile.mkdtemp(prefix="logengine-ckpt-", dir=os.environ.get("LOGENGINE_SCRATCH", "/tmp"))
        context.setCheckpointDir(base)
    return named or context.getCheckpointDir()
