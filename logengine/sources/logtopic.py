"""The ``logtopic`` log rows: ``(off BIGINT, record_ts TIMESTAMP, value STRING)``.

This is the normalised form of a log topic record (offset, arrival time,
value text). For batch work and tests it is derived from the ``events``
table: every event becomes one service log row, every fifth ``error``
event also gets a continuation row (a stack frame without a level).
Time is compressed by 600 so the 30 days of events fall into 72 minutes
and the 5 s / 15 s / 30 s windows hold many rows.

The derivation is one scan and one generator: no shuffle, and it scales
linearly with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.functions.time import epoch_us_ntz, int_div, ntz_from_millis
from logengine.session import use_utc
from logengine.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the log-row derivation (shared with the DuckDB oracle)
# ---------------------------------------------------------------------------
# Arrival time of the first row: 2017-01-13 19:57:16.366 UTC, in epoch ms.
BASE_MS = 1484337436366
# Start of the events table time range: 2024-01-01 00:00:00 UTC, epoch µs.
EVENTS_START_US = 1704067200000000
# Time compression by 600: event µs divided by this give log ms.
COMPRESS_US_PER_MS = 600000
# Level by event type; anything else is FATAL (no level marker).
LEVEL_BY_EVENT = {"error": "ERROR", "view": "INFO", "click": "DEBUG", "purchase": "WARN"}
OTHER_LEVEL = "FATAL"
HOST_PREFIX = "flume-agent-0"
N_HOSTS = 3
# ---------------------------------------------------------------------------

LOG_SCHEMA = "off BIGINT, record_ts TIMESTAMP, value STRING"


def _arrival_ms(ts: Column) -> Column:
    us = epoch_us_ntz(ts.cast("timestamp_ntz"))
    return F.lit(BASE_MS) + int_div(us - F.lit(EVENTS_START_US), COMPRESS_US_PER_MS)


def log_rows_from_events(events: DataFrame) -> DataFrame:
    """Derive log rows from an ``events``-shaped frame (batch or stream)."""
    ev = events.select(
        "event_id", "user_id", "event_type", "props",
        _arrival_ms(F.col("ts")).cast("long").alias("ms"),
    )
    level = F.lit(OTHER_LEVEL)
    for et, lv in reversed(list(LEVEL_BY_EVENT.items())):
        level = F.when(F.col("event_type") == et, F.lit(lv)).otherwise(level)
    host = F.concat(F.lit(HOST_PREFIX), (F.pmod(F.col("user_id"), F.lit(N_HOSTS)) + 1).cast("string"))
    service = F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit("namenode")).otherwise(F.lit("datanode"))
    line_ts = F.date_format(ntz_from_millis(F.col("ms")), "yyyy-MM-dd HH:mm:ss,SSS")
    suffix = F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(" after ERROR")).otherwise(F.lit(""))
    value = F.concat(
        host, F.lit(" "), service, F.lit(" "), line_ts, F.lit(" "), level,
        F.lit(" org.example.Server: event "), F.col("event_id").cast("string"),
        suffix, F.lit(" props="), F.col("props"),
    )
    header = F.struct((F.col("event_id") * 2).alias("off"), value.alias("value"))
    continuation = F.when(
        (F.col("event_type") == "error") & (F.pmod(F.col("event_id"), F.lit(5)) == 0),
        F.struct(
            (F.col("event_id") * 2 + 1).alias("off"),
            F.concat(F.lit("\tat org.example.Foo.bar(Foo.java:"), F.col("event_id").cast("string"), F.lit(")")).alias("value"),
        ),
    )
    # One scan; both rows of an event come out of one generator. The
    # generated ``value`` is a real column for everything above it, so a
    # filter on it is not pushed below (which would inline and re-run the
    # whole concat once per reference).
    return ev.select(
        F.timestamp_millis(F.col("ms")).alias("record_ts"),
        F.explode(F.filter(F.array(header, continuation), lambda r: r.isNotNull())).alias("_r"),
    ).select(F.col("_r.off").alias("off"), "record_ts", F.col("_r.value").alias("value"))


def logtopic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ``logtopic`` rows derived from ``{sf_dir}/events.parquet``."""
    use_utc(spark)
    return log_rows_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"]))
