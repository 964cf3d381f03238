"""Result shaping: count lines, tick payloads, JSON documents, snapshots.

Formatting runs on executors as column expressions; nothing is collected
to the driver. The keys of a tick are dealt into a fixed number of parts
by a hash of the key (``TICK_PARTS``, whatever the size), each written on
its own, so no task and no value holds a whole tick.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logengine.functions.lineproto import escape_key
from logengine.functions.text import series_key
from logengine.functions.time import epoch_ns, java_timestamp_text
from logengine.operators.windows import key_part

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
COUNT_MEASUREMENT = "logtype_count"
COUNT_TAG = "host_service_logtype"
COUNT_FIELD = "count"
# ---------------------------------------------------------------------------

#: Parts that the keys of a tick are dealt into.
TICK_PARTS = 8


def count_lines(counts: DataFrame, escape: bool = True, with_time: bool = False) -> DataFrame:
    """``(tick, line)``: ``logtype_count,host_service_logtype=<h>_<s>_<l> count=<n>``.

    ``count`` keeps the reference's bare number (no ``i``). ``escape`` applies
    the key escaper to the tag value (equal unless a token holds space,
    comma or ``=``). ``with_time`` appends the tick in ns so a replay
    rewrites the same points instead of adding new ones.
    """
    tag = series_key("hostName", "serviceName", "logType")
    if escape:
        tag = escape_key(tag)
    parts = [F.lit(f"{COUNT_MEASUREMENT},{COUNT_TAG}="), tag, F.lit(f" {COUNT_FIELD}="), F.col("cnt").cast("string")]
    if with_time:
        parts += [F.lit(" "), epoch_ns("tick").cast("string")]
    kept = ["part"] if "part" in counts.columns else []
    return counts.select("tick", *kept, F.concat(*parts).alias("line"))


def with_part(counts: DataFrame, parts: int = TICK_PARTS) -> DataFrame:
    """``counts`` with the ``part`` of each key (kept if it is there)."""
    if "part" in counts.columns:
        return counts
    return counts.withColumn("part", key_part(series_key("hostName", "serviceName", "logType"), parts))


def tick_payload(lines: DataFrame) -> DataFrame:
    """``(tick, part, n_lines, payload)``: the lines of each part of a tick,
    sorted, each ending in a newline (``lines`` from :func:`with_part` counts)."""
    return lines.groupBy("tick", "part").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.concat(F.array_join(F.array_sort(F.collect_list("line")), "\n"), F.lit("\n")).alias("payload"),
    )


def count_documents(counts: DataFrame) -> DataFrame:
    """``(key, tick, value)``: per group a one-element JSON array
    ``[{timeStamp, hostName, serviceName, logType, count}]``, count as text."""
    doc = F.struct(
        java_timestamp_text("tick").alias("timeStamp"),
        "hostName",
        "serviceName",
        "logType",
        F.col("cnt").cast("string").alias("count"),
    )
    return counts.select(
        series_key("hostName", "serviceName", "logType").alias("key"),
        "tick",
        F.to_json(F.array(doc)).alias("value"),
    )


def tick_snapshot(counts: DataFrame, parts: int = TICK_PARTS) -> DataFrame:
    """``(key, part, value)``: per tick, key = tick text, value = JSON array
    of ``{host_service_logtype, count}`` sorted by key. ``part`` belongs to
    the key of what is written; ``parts=1`` gives one value per tick."""
    k = series_key("hostName", "serviceName", "logType")
    entry = F.struct(k.alias(COUNT_TAG), F.col("cnt").cast("string").alias(COUNT_FIELD))
    parted = with_part(counts, parts).select("tick", "part", entry.alias("_e"))
    return parted.groupBy("tick", "part").agg(F.to_json(F.array_sort(F.collect_list("_e"))).alias("value")).select(
        java_timestamp_text("tick").alias("key"), "part", "value"
    )
