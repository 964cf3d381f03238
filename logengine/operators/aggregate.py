"""Counts over log records and words.

Raw rows only meet hash aggregates (counts, sums and fixed-width maxima),
so a hot key is combined map-side, without a sort: a key holding a third
of all rows sends one row per task, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logengine.functions.text import FIXED_LEVELS, java_split, series_key
from logengine.operators.windows import US, arrival_order, chained, pane_end_us, sliding_count

LEVEL_KEYS = ["hostName", "serviceName", "logType"]


def level_count(records: DataFrame) -> DataFrame:
    """``SELECT hostName, serviceName, logType, COUNT(logType) ... GROUP BY`` all three."""
    return records.groupBy(*LEVEL_KEYS).agg(F.count("logType").alias("cnt"))


def fixed_level_count(records: DataFrame) -> DataFrame:
    """The same count for exactly INFO, DEBUG, WARN, ERROR, in one pass
    (one scan, one shuffle) instead of four filtered GROUP BYs."""
    return level_count(records.where(F.col("logType").isin(*FIXED_LEVELS)))


def union_levels(records: DataFrame) -> DataFrame:
    """What the four-branch UNION ALL gives, in one pass over the input."""
    return fixed_level_count(records)


def union_levels_by_branch(records: DataFrame) -> DataFrame:
    """The UNION ALL written out: one aggregate per level, four scans. Only
    for checking :func:`union_levels` against it."""
    parts = [
        records.where(F.col("logType") == lv)
        .groupBy("hostName", "serviceName")
        .agg(F.count("logType").alias("cnt"))
        .select("hostName", "serviceName", F.lit(lv).alias("logType"), "cnt")
        for lv in FIXED_LEVELS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_count_per_tick(records: DataFrame, slide_s: int = 5, ts_col: str = "record_ts",
                       parts: int = 0) -> DataFrame:
    """``(tick, key, cnt)``: per-batch count of each ``host_service_level``."""
    keyed = records.select(ts_col, series_key("hostName", "serviceName", "logType").alias("key"))
    return sliding_count(keyed, ["key"], slide_s, slide_s, ts_col=ts_col, count_col="key", parts=parts)


def latest_level(records: DataFrame, ts_col: str = "record_ts") -> DataFrame:
    """Last-writer-wins level per host, made deterministic: latest arrival,
    then highest offset.

    Raw rows are hash-aggregated to the latest moment of each (host, level)
    first (the moment is one fixed-width number, so the buffer needs no
    sort); the few rows left decide each host."""
    last = records.groupBy("hostName", "logType").agg(F.max(arrival_order(records, ts_col)).alias("_at"))
    return last.groupBy("hostName").agg(F.max_by("logType", F.struct("_at", "logType")).alias("logType"))


def words(texts: DataFrame, text_col: str, keep: tuple[str, ...] = (), with_pos: bool = True) -> DataFrame:
    """One row per word (Java split at U+0020), with its 0-based position
    unless ``with_pos=False``."""
    if with_pos:
        return texts.select(*keep, F.posexplode(java_split(text_col)).alias("pos", "word"))
    return texts.select(*keep, F.explode(java_split(text_col)).alias("word"))


def word_count(texts: DataFrame, text_col: str = "text") -> DataFrame:
    return words(texts, text_col, with_pos=False).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_count(rows: DataFrame, slide_s: int = 5, ts_col: str = "record_ts") -> DataFrame:
    """``(word, tick, cnt, total)``: per-tick word count and its running total
    over all earlier ticks (state never expires, as ``updateStateByKey``).

    Rows are aggregated to (word, tick) first; totals run span by span
    (:func:`logengine.operators.windows.chained`), so a word that is in
    every tick of a year is spread over as many tasks as it has spans.
    Ticks where a word is absent are not re-emitted here (that grid is
    words × ticks); the stream form in ``streaming`` re-emits all keys.
    """
    per_tick = (
        words(rows, "value", keep=(ts_col,), with_pos=False)
        .groupBy(F.struct("word").alias("_g"), pane_end_us(ts_col, slide_s).alias("_te"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    own = Window.partitionBy("_g", "_span").orderBy("_te").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return chained(per_tick, "_te", slide_s * US, "cnt").select(
        "_g.word", F.timestamp_micros("_te").alias("tick"), "cnt", (F.col("_base_cnt") + F.sum("cnt").over(own)).alias("total")
    )


def windowed_word_count(rows: DataFrame, length_s: int = 30, slide_s: int = 5, ts_col: str = "record_ts",
                        method: str = "pane") -> DataFrame:
    """``(tick, word, cnt)``: sliding count per word."""
    return sliding_count(words(rows, "value", keep=(ts_col,), with_pos=False), ["word"], length_s, slide_s, ts_col=ts_col,
                         count_col="word", method=method)


def tick_preview(counts: DataFrame, n: int = 10, order_col: str = "key") -> DataFrame:
    """First ``n`` rows of each tick (what a per-batch ``print()`` shows),
    ordered by key so it is repeatable. The input is already aggregated, so
    a tick partition holds one row per key."""
    w = Window.partitionBy("tick").orderBy(order_col)
    return counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
