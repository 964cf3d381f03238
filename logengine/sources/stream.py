"""Streaming log sources, normalised to ``(off, record_ts, value)``.

* Kafka (``format="kafka"``): subscribe to topics, partitions read in
  parallel one task each, offsets tracked in the query checkpoint (no
  auto commit), start at ``latest`` unless told otherwise; the value is
  deserialised as a UTF-8 string. The Kafka connector jar must be on the
  classpath of the cluster; it is not needed for anything else.
* Any file format (``parquet``, ``json``, ``text`` ...): files already in
  the log-row schema, or ``events``-shaped files turned into log rows by
  :func:`logengine.sources.logtopic.log_rows_from_events`.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.session import use_utc
from logengine.sources.logtopic import LOG_SCHEMA, log_rows_from_events

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
DEFAULT_TOPIC = "logtopic"
DEFAULT_STARTING_OFFSETS = "latest"
# ---------------------------------------------------------------------------

# Kafka offsets are per partition; ``off`` is the pair (partition, offset) as
# one decimal number, partition above the whole 63-bit offset range, so no
# offset runs into the next partition's.
PARTITION_STEP = Decimal(1 << 63)
OFF_TYPE = "decimal(30,0)"

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def kafka_options(bootstrap_servers: str, topics: str = DEFAULT_TOPIC, starting_offsets: str = DEFAULT_STARTING_OFFSETS,
                  group_id: str | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def normalise_kafka(records: DataFrame) -> DataFrame:
    """Kafka rows ``(key, value, topic, partition, offset, timestamp, ...)``
    → ``(off, record_ts, value)``; only the value is used."""
    return records.select(
        (F.col("partition").cast("decimal(10,0)") * F.lit(PARTITION_STEP).cast("decimal(19,0)") + F.col("offset"))
        .cast(OFF_TYPE).alias("off"),
        F.col("timestamp").alias("record_ts"),
        F.col("value").cast("string").alias("value"),
    )


def read_log_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    options: Mapping[str, str] | None = None, events_shaped: bool = False) -> DataFrame:
    """A streaming frame of log rows from Kafka or from files."""
    use_utc(spark)
    opts = dict(options or {})
    if fmt == "kafka":
        if "subscribe" not in opts and "subscribePattern" not in opts and "assign" not in opts:
            opts["subscribe"] = DEFAULT_TOPIC
        opts.setdefault("startingOffsets", DEFAULT_STARTING_OFFSETS)
        return normalise_kafka(spark.readStream.format("kafka").options(**opts).load())
    reader = spark.readStream.format(fmt).options(**opts)
    if events_shaped:
        return log_rows_from_events(reader.schema(EVENTS_SCHEMA).load(path))
    return reader.schema(LOG_SCHEMA).load(path).select("off", "record_ts", "value")
