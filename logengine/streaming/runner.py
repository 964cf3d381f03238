"""Stream runner: the log jobs as Structured Streaming queries.

source → parse → window + count → shape → sink, one plan per query; the
per-tick body runs in ``foreachBatch`` on the micro-batch frame (no
collect: rows stay on executors and are written by Spark's writers).

* trigger: ``processingTime`` (5 s, the reference cadence) or
  ``availableNow`` (tests, backfills)
* checkpoint: ``checkpointLocation`` under the cluster's
  ``spark.checkpoint.dir`` unless given; a restart resumes from it (without
  either, starting is an error)
* time column: ``arrival_ts`` (default), the time of the micro-batch that
  reads the row: the reference's meaning. No row can be late, so a zero
  watermark closes every window once, complete, and state holds the open
  windows only. ``record_ts`` (the source's own time) and ``event_ts`` (the
  parsed one) need an explicit watermark for append mode; rows beyond it
  are dropped by Spark, rows whose time does not parse are in
  :func:`logengine.operators.parse.untimed`
* clock: Spark moves the watermark by rows, so on a silent source the last
  windows would stay open and no tick would run. ``clock=True`` adds one
  clock row per micro-batch, which moves the watermark and is filtered out
  behind it: every slide has its tick, windows close by the time of day. The
  packaged jobs have it when they run on a trigger interval and arrival time
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logengine.functions.text import FIXED_LEVELS
from logengine.operators import aggregate as agg
from logengine.operators.parse import parse_log
from logengine.operators.shape import count_lines

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
TICK = "5 seconds"
FLAGSHIP_LENGTH_S, FLAGSHIP_SLIDE_S = 15, 5
VARIANT_LENGTH_S, VARIANT_SLIDE_S = 30, 5
EMPTY_TICK_MESSAGE = "No cdh role logs in this time interval"
# ---------------------------------------------------------------------------


# Settings for large window state on a cluster: RocksDB keeps state off the
# JVM heap and checkpoints changelogs instead of full snapshots. Set them on
# the session before a query first starts (they are kept in its checkpoint).
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass
class StreamConfig:
    """How a query runs: trigger, output mode, checkpoint, name."""

    query_name: str
    output_mode: str = "update"
    trigger_interval: str | None = TICK
    available_now: bool = False
    checkpoint: str | None = None


def checkpoint_location(df: DataFrame, cfg: StreamConfig) -> str:
    if cfg.checkpoint:
        return cfg.checkpoint
    base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("a stream needs StreamConfig.checkpoint or spark.checkpoint.dir, or it could not resume")
    return f"{base.rstrip('/')}/streams/{cfg.query_name}"


ARRIVAL = "arrival_ts"


def _stamped(rows: DataFrame, ts_col: str, watermark: str | None) -> tuple[DataFrame, str | None]:
    """Rows with the time of their micro-batch (one value per batch), and
    the watermark: zero is lossless there, as a batch is never older."""
    if ts_col != ARRIVAL:
        return rows, watermark
    return rows.withColumn(ARRIVAL, F.current_timestamp()), watermark or "0 seconds"


_CLOCK = "_clock"


def clock_rows(spark: SparkSession, ts_col: str) -> DataFrame:
    """One row in every micro-batch, whether or not anything arrives: the batch's time."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    return ticks.select(F.current_timestamp().alias(ts_col), F.lit(True).alias(_CLOCK))


def _ticking(cfg: StreamConfig, ts_col: str) -> bool:
    """The query runs on the clock: a trigger interval, windows on arrival time."""
    return ts_col == ARRIVAL and cfg.trigger_interval is not None and not cfg.available_now


def _records(rows: DataFrame, ts_col: str, watermark: str | None, legacy_offset: bool, clock: bool = False) -> DataFrame:
    rows, watermark = _stamped(rows, ts_col, watermark)
    keep = ("off", "record_ts", *([ARRIVAL] if ts_col == ARRIVAL else []))
    recs = parse_log(rows, legacy_offset=legacy_offset, keep=keep)
    if ts_col == "event_ts":
        recs = recs.where(F.col("event_ts").isNotNull())
    if clock:
        if not watermark:
            raise ValueError("a clock moves a watermark: give one")
        recs = recs.withColumn(_CLOCK, F.lit(False)).unionByName(clock_rows(rows.sparkSession, ts_col), allowMissingColumns=True)
    if watermark:
        recs = recs.withWatermark(ts_col, watermark)
    if clock:
        # The time column in the condition keeps it above the watermark, which needs the clock rows.
        recs = recs.where(~F.col(_CLOCK) | (F.unix_micros(ts_col) < 0)).drop(_CLOCK)
    return recs


def sliding_counts_stream(rows: DataFrame, length_s: int = FLAGSHIP_LENGTH_S, slide_s: int = FLAGSHIP_SLIDE_S,
                          ts_col: str = ARRIVAL, watermark: str | None = None, fixed_levels: bool = False,
                          legacy_offset: bool = False, clock: bool = False) -> DataFrame:
    """``(tick, hostName, serviceName, logType, cnt)`` as a streaming aggregate."""
    recs = _records(rows, ts_col, watermark, legacy_offset, clock)
    if fixed_levels:
        recs = recs.where(F.col("logType").isin(*FIXED_LEVELS))
    w = F.window(ts_col, f"{length_s} seconds", f"{slide_s} seconds")
    return (
        recs.groupBy(w.alias("_w"), *agg.LEVEL_KEYS)
        .agg(F.count("logType").alias("cnt"))
        .select(F.col("_w.end").alias("tick"), *agg.LEVEL_KEYS, "cnt")
    )


def latest_level_stream(rows: DataFrame, length_s: int = VARIANT_LENGTH_S, slide_s: int = VARIANT_SLIDE_S,
                        ts_col: str = ARRIVAL, watermark: str | None = None, clock: bool = False) -> DataFrame:
    """``(tick, hostName, logType, record_ts, off)``: last level per host per
    window, with the moment that decided it."""
    recs = _records(rows, ts_col, watermark, False, clock)
    w = F.window(ts_col, f"{length_s} seconds", f"{slide_s} seconds")
    return (
        recs.groupBy(w.alias("_w"), "hostName")
        .agg(F.max(F.struct("record_ts", "off", "logType")).alias("_m"))
        .select(F.col("_w.end").alias("tick"), "hostName", "_m.logType", "_m.record_ts", "_m.off")
    )


def running_word_count_stream(rows: DataFrame) -> DataFrame:
    """Total per word over all history (run in ``complete`` mode: every
    known word is re-emitted each tick, state never expires)."""
    return agg.words(rows, "value", with_pos=False).groupBy("word").agg(F.count(F.lit(1)).alias("total"))


def running_word_count_ttl_stream(rows: DataFrame, ttl_ms: int, watermark: str | None = None,
                                  ts_col: str = ARRIVAL) -> DataFrame:
    """Running total per word whose state expires once the stream's
    event-time watermark passes ``ttl_ms`` after the word was last seen
    (the reference keeps every key forever). Output mode ``update``: each
    tick emits the words seen in it with their running total.

    Stateful per-key logic Spark's built-in aggregate cannot express, so it
    runs in ``applyInPandasWithState``. Words are counted per Arrow batch
    before the shuffle, so a hot word sends one row per batch to its state,
    not every occurrence. Only the word and its time cross to Python. The
    timeout is event-time
    (on ``ts_col`` with ``watermark``), so expiry is deterministic and an
    ``availableNow`` run terminates."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    if ttl_ms <= 0:
        raise ValueError("ttl_ms must be positive")

    def update(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        total, last = state.get if state.exists else (0, 0)
        for pdf in batches:
            total += int(pdf["n"].sum())
            last = max(last, int(pdf["ms"].max()))
        state.update((total, last))
        state.setTimeoutTimestamp(last + ttl_ms)
        yield pd.DataFrame({"word": [key[0]], "total": [total]})

    return _word_batches(rows, ts_col, watermark).groupBy("word").applyInPandasWithState(
        update, "word string, total long", "total long, last_ms long", "update", GroupStateTimeout.EventTimeTimeout
    )


def _word_batches(rows: DataFrame, ts_col: str, watermark: str | None) -> DataFrame:
    """``(word, ts_col, ms, n)``: words counted per Arrow batch before the
    shuffle, so a hot word sends one row per batch to its state."""
    rows, watermark = _stamped(rows, ts_col, watermark)
    if not watermark:
        raise ValueError(f"{ts_col} needs a watermark")

    def combine(batches):
        for pdf in batches:
            yield pdf.groupby("word", as_index=False).agg(**{ts_col: (ts_col, "max"), "n": (ts_col, "size")})

    w = agg.words(rows, "value", keep=(ts_col,), with_pos=False).select("word", ts_col)
    w = w.mapInPandas(combine, f"word string, {ts_col} timestamp, n long").withWatermark(ts_col, watermark)
    # the event-time column stays in the input: it carries the watermark
    return w.select("word", ts_col, F.unix_millis(ts_col).alias("ms"), "n")


def key_count_stream(rows: DataFrame, ts_col: str = ARRIVAL, watermark: str | None = None,
                     clock: bool = False) -> DataFrame:
    """Per-tick (tumbling 5 s) count per ``host_service_level``."""
    recs = _records(rows, ts_col, watermark, False, clock)
    key = F.concat_ws("_", "hostName", "serviceName", "logType")
    return (
        recs.groupBy(F.window(ts_col, TICK).alias("_w"), key.alias("key"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("_w.end").alias("tick"), "key", "cnt")
    )


def foreach_tick(fn: Callable[[DataFrame, int], None],
                 on_empty: Callable[[int], None] | None = None,
                 persist: bool = True) -> Callable[[DataFrame, int], None]:
    """Wrap a per-tick body with the emptiness guard: an empty micro-batch
    calls ``on_empty`` (default: the reference's message, on stderr).

    The guard and the body are two actions on the same micro-batch, and
    each would re-run the batch's plan (state store read included), so the
    batch is persisted (memory, spilling to disk) for the tick and released
    after it."""

    def body(batch: DataFrame, batch_id: int) -> None:
        if persist:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                (on_empty or (lambda _b: print(EMPTY_TICK_MESSAGE, file=sys.stderr)))(batch_id)
                return
            fn(batch, batch_id)
        finally:
            if persist:
                batch.unpersist()

    return body


def sql_tick(statement: str, sink: Callable[[DataFrame, int], None], view: str = "cdhrolelogs") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that registers the micro-batch as ``view`` and
    hands ``spark.sql(statement)`` to ``sink`` — the per-tick SQL form,
    with the result written from executors (no collect)."""

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.createOrReplaceTempView(view)
        sink(batch.sparkSession.sql(statement), batch_id)

    return body


def append(cfg: StreamConfig) -> StreamConfig:
    """The same run in append mode: each window once, when it is final."""
    return replace(cfg, output_mode="append")


def start(df: DataFrame, cfg: StreamConfig, batch_fn: Callable[[DataFrame, int], None] | None = None,
          fmt: str | None = None, options: dict[str, str] | None = None) -> StreamingQuery:
    """Start a streaming query with a ``foreachBatch`` body or a sink format."""
    w = df.writeStream.queryName(cfg.query_name).outputMode(cfg.output_mode)
    w = w.option("checkpointLocation", checkpoint_location(df, cfg))
    if cfg.available_now:
        w = w.trigger(availableNow=True)
    elif cfg.trigger_interval:
        w = w.trigger(processingTime=cfg.trigger_interval)
    if batch_fn is not None:
        w = w.foreachBatch(batch_fn)
    elif fmt:
        w = w.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until an ``availableNow`` query finishes (or ``timeout_s``), then stop."""
    try:
        query.awaitTermination(timeout_s)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()


def flagship_stream(rows: DataFrame, sink_path: str, database: str, cfg: StreamConfig,
                    retention_policy: str = "autogen", ts_col: str = ARRIVAL, watermark: str | None = None,
                    compression: str | None = None,
                    on_empty: Callable[[int], None] | None = None, with_time: bool = False,
                    length_s: int = FLAGSHIP_LENGTH_S, slide_s: int = FLAGSHIP_SLIDE_S) -> StreamingQuery:
    """The packaged job: 15 s / 5 s sliding level counts → count lines →
    line-protocol payload files. Append mode: a window is written once,
    when it is closed, whole. On a trigger interval every tick runs, with
    ``on_empty`` where no window that it closes has a record.

    ``with_time=True`` stamps each line with its tick (ns), so a replayed or
    re-emitted window overwrites the same points downstream instead of
    adding new ones (the reference leaves the time to the server)."""
    from logengine.streaming.sinks import line_protocol_sink

    counts = sliding_counts_stream(rows, length_s, slide_s, ts_col, watermark, clock=_ticking(cfg, ts_col))
    sink = line_protocol_sink(sink_path, database, retention_policy, compression=compression)
    return start(counts, append(cfg), foreach_tick(lambda b, i: sink(count_lines(b, with_time=with_time), i),
                                           on_empty=on_empty))


