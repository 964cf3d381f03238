"""The reference's six streaming jobs, each one call: source frame in,
running ``StreamingQuery`` out. They compose the operators and sinks of
this package; nothing here collects to the driver.

=====================  =====================================================
job                    what it does
=====================  =====================================================
key_count_job          per 5 s tick, count per ``host_service_level`` → console
flagship_job           15 s / 5 s level counts → count lines → payload files
documents_job          30 s / 5 s, four levels → one JSON document per key per
                       tick → append list
latest_level_job       30 s / 5 s, last level per host → key/value store
snapshot_job           30 s / 5 s, four levels → one JSON snapshot per tick →
                       keyed put
word_count_job         per-tick word counts → console
=====================  =====================================================

Windows are on arrival time (the micro-batch that reads a row) by default,
as in the reference: no row is late and none is dropped; on a trigger
interval a clock closes windows and runs ticks when nothing arrives. Jobs whose output
must describe a *whole* window (lines, documents, snapshots) run in append
mode, so each window is written once, when final; with ``record_ts`` or
``event_ts`` give the ``watermark`` to wait for stragglers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logengine.operators import aggregate as agg
from logengine.operators.shape import count_documents, tick_snapshot
from logengine.streaming.runner import (
    StreamConfig,
    VARIANT_LENGTH_S,
    ARRIVAL,
    _ticking,
    VARIANT_SLIDE_S,
    append,
    flagship_stream,
    foreach_tick,
    key_count_stream,
    latest_level_stream,
    sliding_counts_stream,
    start,
)
from logengine.streaming.sinks import append_list_sink, console, keyed_upsert_sink, read_latest

PREVIEW_ROWS = 10


def key_count_job(rows: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    q = console(key_count_stream(rows), num_rows=PREVIEW_ROWS).queryName(cfg.query_name).outputMode("update")
    return _finish(q, rows, cfg)


def flagship_job(rows: DataFrame, sink_path: str, database: str, cfg: StreamConfig, **kwargs) -> StreamingQuery:
    return flagship_stream(rows, sink_path, database, cfg, **kwargs)


def documents_job(rows: DataFrame, sink_path: str, cfg: StreamConfig, ts_col: str = ARRIVAL,
                  watermark: str | None = None) -> StreamingQuery:
    counts = sliding_counts_stream(rows, VARIANT_LENGTH_S, VARIANT_SLIDE_S, ts_col, watermark, fixed_levels=True,
                                   clock=_ticking(cfg, ts_col))
    sink = append_list_sink(sink_path)
    return start(counts, append(cfg), foreach_tick(lambda b, i: sink(count_documents(b), i)))


def latest_level_job(rows: DataFrame, store_path: str, cfg: StreamConfig, ts_col: str = ARRIVAL,
                     watermark: str | None = None) -> StreamingQuery:
    """Per window, the last level per host; each tick stores host → level
    with the arrival time and offset that decided it. The target resolves by
    these (:func:`latest_levels`), so a late row never goes back in time."""
    latest = latest_level_stream(rows, VARIANT_LENGTH_S, VARIANT_SLIDE_S, ts_col, watermark, _ticking(cfg, ts_col))
    sink = keyed_upsert_sink(store_path)

    def put(batch: DataFrame, batch_id: int) -> None:
        moment = F.struct("record_ts", "off")
        per_host = batch.groupBy("hostName").agg(F.max_by(F.struct("logType", "record_ts", "off"), moment).alias("m"))
        sink(per_host.select(F.col("hostName").alias("key"), F.col("m.logType").alias("value"), "m.record_ts", "m.off"), batch_id)

    return start(latest, cfg, foreach_tick(put))


def latest_levels(spark: SparkSession, store_path: str) -> DataFrame:
    """``(key, value)``: what the store of :func:`latest_level_job` holds."""
    return read_latest(spark, store_path, ["key"], ["record_ts", "off"]).select("key", "value")


def snapshot_job(rows: DataFrame, sink_path: str, cfg: StreamConfig, ts_col: str = ARRIVAL,
                 watermark: str | None = None) -> StreamingQuery:
    counts = sliding_counts_stream(rows, VARIANT_LENGTH_S, VARIANT_SLIDE_S, ts_col, watermark, fixed_levels=True,
                                   clock=_ticking(cfg, ts_col))
    sink = keyed_upsert_sink(sink_path)
    return start(counts, append(cfg), foreach_tick(lambda b, i: sink(tick_snapshot(b), i)))


def word_count_job(rows: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    """Per-tick word counts (tumbling 5 s on arrival time) → console."""
    w = agg.words(rows.withColumn(ARRIVAL, F.current_timestamp()), "value", keep=(ARRIVAL,), with_pos=False)
    counts = w.withWatermark(ARRIVAL, "0 seconds").groupBy(F.window(ARRIVAL, "5 seconds").alias("_w"), "word").agg(F.count(F.lit(1)).alias("cnt")) \
        .select(F.col("_w.end").alias("tick"), "word", "cnt")
    q = console(counts, num_rows=PREVIEW_ROWS).queryName(cfg.query_name).outputMode("update")
    return _finish(q, rows, cfg)


def _finish(writer, rows: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    from logengine.streaming.runner import checkpoint_location

    writer = writer.option("checkpointLocation", checkpoint_location(rows, cfg))
    if cfg.available_now:
        writer = writer.trigger(availableNow=True)
    elif cfg.trigger_interval:
        writer = writer.trigger(processingTime=cfg.trigger_interval)
    return writer.start()
