"""Structured Streaming: batch/stream parity, restart from checkpoint,
late data, per-tick guard, and the sinks."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

from pyspark.sql import functions as F

from logengine.operators import aggregate as agg
from logengine.operators import parse, shape, windows
from logengine.sources.logtopic import logtopic
from logengine.sources.stream import normalise_kafka, read_log_stream
from logengine.streaming.runner import (
    StreamConfig,
    flagship_stream,
    foreach_tick,
    running_word_count_stream,
    running_word_count_ttl_stream,
    run_to_end,
    sliding_counts_stream,
    sql_tick,
    start,
)
from logengine.streaming.sinks import (
    append_list_sink,
    keyed_upsert_sink,
    read_append_list,
    read_keyed,
)

from .conftest import SF_SMALL, log_frame

TIMEOUT = 180


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _write_chunks(spark, rows, path, n):
    rows.repartitionByRange(n, "record_ts").write.mode("append").parquet(path)


def test_stream_equals_batch_complete_mode(spark, scratch):
    rows = logtopic(spark, SF_SMALL)
    src = os.path.join(scratch, "src")
    _write_chunks(spark, rows, src, 4)
    stream = read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"})
    q = start(sliding_counts_stream(stream, ts_col="record_ts"),
              StreamConfig("parity_counts", output_mode="complete", available_now=True,
                           checkpoint=os.path.join(scratch, "ck")), fmt="memory")
    run_to_end(q, TIMEOUT)
    batch = windows.sliding_count(parse.parse_log(rows), agg.LEVEL_KEYS, 15, 5, method="window")
    assert _same(spark.table("parity_counts"), batch)


def test_restart_from_checkpoint_keyed_upsert(spark, scratch):
    rows = logtopic(spark, SF_SMALL)
    cut = rows.agg(F.percentile_approx(F.unix_micros("record_ts"), 0.5)).first()[0]
    first = rows.where(F.unix_micros("record_ts") < cut)
    second = rows.where(F.unix_micros("record_ts") >= cut)
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))
    counts_cfg = StreamConfig("restart_counts", output_mode="update", available_now=True, checkpoint=ck)

    _write_chunks(spark, first, src, 2)
    run_to_end(start(sliding_counts_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"}), ts_col="record_ts"),
                     counts_cfg, keyed_upsert_sink(out)), TIMEOUT)
    n_batches_first = len(glob.glob(os.path.join(out, "batch_id=*")))
    _write_chunks(spark, second, src, 2)
    run_to_end(start(sliding_counts_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"}), ts_col="record_ts"),
                     counts_cfg, keyed_upsert_sink(out)), TIMEOUT)
    assert len(glob.glob(os.path.join(out, "batch_id=*"))) > n_batches_first

    got = read_keyed(spark, out, ["tick", *agg.LEVEL_KEYS])
    batch = windows.sliding_count(parse.parse_log(rows), agg.LEVEL_KEYS, 15, 5)
    assert _same(got.select(batch.columns), batch)


def _late_data_run(spark, scratch, ts_col, watermark):
    on_time = [f"h1 svc 2017-01-13 19:57:{s:02d},000 INFO x" for s in range(10, 60, 5)]
    late = ["h1 svc 2017-01-13 19:57:01,000 INFO late"]
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))
    cfg = StreamConfig("late", output_mode="update", available_now=True, checkpoint=ck)
    log_frame(spark, on_time, start_ms=1_000_000).coalesce(1).write.mode("append").parquet(src)
    run_to_end(start(sliding_counts_stream(read_log_stream(spark, "parquet", src), ts_col=ts_col, watermark=watermark),
                     cfg, keyed_upsert_sink(out)), TIMEOUT)
    log_frame(spark, late, start_ms=2_000_000).coalesce(1).write.mode("append").parquet(src)
    run_to_end(start(sliding_counts_stream(read_log_stream(spark, "parquet", src), ts_col=ts_col, watermark=watermark),
                     cfg, keyed_upsert_sink(out)), TIMEOUT)
    return read_keyed(spark, out, ["tick", *agg.LEVEL_KEYS])


def test_late_rows_dropped_with_event_time_watermark(spark, scratch):
    got = _late_data_run(spark, scratch, "event_ts", "10 seconds")
    ticks = {r["tick"] for r in got.collect()}
    assert dt.datetime(2017, 1, 13, 19, 57, 5) not in ticks  # the late row's first window never appears
    assert got.agg(F.sum("cnt")).first()[0] == 10 * 3


def test_arrival_time_keeps_everything(spark, scratch):
    got = _late_data_run(spark, scratch, "record_ts", None)
    assert got.agg(F.sum("cnt")).first()[0] == 11 * 3


def test_foreach_tick_empty_guard(spark):
    seen = []
    body = foreach_tick(lambda df, i: seen.append(("rows", i)), on_empty=lambda i: seen.append(("empty", i)))
    body(spark.range(0), 7)
    body(spark.range(3), 8)
    assert seen == [("empty", 7), ("rows", 8)]


SENTINEL = ["h9 svc 2017-01-13 23:00:00,000 INFO sentinel"]


def _lines(spark, out):
    return spark.read.text(out).where(F.col("value") != "").select(F.col("value").alias("line"))


def test_flagship_stream_writes_each_window_once(spark, scratch):
    """Several micro-batches: every window is written once, whole."""
    rows = logtopic(spark, SF_SMALL)
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))

    def run():
        run_to_end(flagship_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"}), out, "logs",
                                   StreamConfig("flagship", available_now=True, checkpoint=ck), ts_col="record_ts",
                                   watermark="2 hours", compression="gzip"), TIMEOUT)

    _write_chunks(spark, rows, src, 4)
    run()
    last_ms = rows.agg(F.max(F.unix_millis("record_ts"))).first()[0]
    log_frame(spark, SENTINEL, start_ms=last_ms + 10_800_000).write.mode("append").parquet(src)
    run()
    files = glob.glob(os.path.join(out, "batch_id=*", "db=logs", "rp=autogen", "consistency=one", "*.gz"))
    assert files
    expected = shape.count_lines(windows.sliding_count(parse.parse_log(rows), agg.LEVEL_KEYS, 15, 5)).select("line")
    assert _same(_lines(spark, out), expected)


def test_flagship_on_arrival_time_loses_nothing(spark, scratch):
    """Rows of any age, the oldest last: each is in its three windows, and the
    state that is left holds the open windows only."""
    import time

    rows = logtopic(spark, SF_SMALL).where(F.col("off") < 400)
    n = parse.parse_log(rows).count()
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))

    def run():
        q = flagship_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"}), out, "logs",
                            StreamConfig("arrival", available_now=True, checkpoint=ck))
        run_to_end(q, TIMEOUT)
        return q.recentProgress

    for part in ("off >= 200", "off < 200"):
        rows.where(part).coalesce(1).write.mode("append").parquet(src)
        run()
    time.sleep(21)
    log_frame(spark, SENTINEL).coalesce(1).write.mode("append").parquet(src)
    progress = run()
    lines = _lines(spark, out).where(~F.col("line").contains("h9_svc"))
    counted = lines.agg(F.sum(F.substring_index("line", "=", -1).cast("long"))).first()[0]
    assert counted == 3 * n
    assert all(op.numRowsDroppedByWatermark == 0 for p in progress for op in p.stateOperators)
    assert progress[-1].stateOperators[0].numRowsTotal <= 3


def test_late_partition_is_not_lost(spark, scratch):
    """Rows a minute older than what was read before reach documents and snapshots."""
    import time

    from logengine.streaming import jobs

    src = os.path.join(scratch, "src")
    outs = {name: os.path.join(scratch, name) for name in ("docs", "snaps")}

    def run():
        for job, name in ((jobs.documents_job, "docs"), (jobs.snapshot_job, "snaps")):
            run_to_end(job(read_log_stream(spark, "parquet", src), outs[name],
                           StreamConfig(name, available_now=True, checkpoint=os.path.join(scratch, "ck-" + name))), TIMEOUT)

    log_frame(spark, ["h1 svc 2017-01-13 19:58:16,367 INFO new"] * 2, start_ms=2_000_000).write.mode("append").parquet(src)
    run()
    log_frame(spark, ["h2 svc 2017-01-13 19:57:16,367 WARN old"] * 3, start_ms=1_940_000).write.mode("append").parquet(src)
    run()
    time.sleep(36)
    log_frame(spark, SENTINEL).write.mode("append").parquet(src)
    run()
    docs = read_append_list(spark, outs["docs"]).where(F.col("key") == "h2_svc_WARN").select(
        F.from_json("value", "array<struct<count: string>>")[0]["count"].cast("long").alias("n"))
    assert docs.agg(F.sum("n")).first()[0] == 3 * 6
    snaps = read_keyed(spark, outs["snaps"], ["key", "part"]).where(F.col("value").contains("h2_svc_WARN"))
    assert snaps.count() == docs.count() > 0


def test_latest_level_never_goes_back(spark, scratch):
    from logengine.streaming import jobs

    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "latest")

    def run():
        run_to_end(jobs.latest_level_job(read_log_stream(spark, "parquet", src), out,
                                         StreamConfig("latest", available_now=True, checkpoint=os.path.join(scratch, "ck"))),
                   TIMEOUT)

    log_frame(spark, ["h1 svc 2017-01-13 19:58:40,000 ERROR newer"], start_ms=100_000).write.mode("append").parquet(src)
    run()
    log_frame(spark, ["h1 svc 2017-01-13 19:57:00,000 INFO late"], start_ms=0).write.mode("append").parquet(src)
    run()
    assert [tuple(r) for r in jobs.latest_levels(spark, out).collect()] == [("h1", "ERROR")]


def test_a_stream_without_checkpoint_is_refused():
    from types import SimpleNamespace

    import pytest

    from logengine.streaming.runner import checkpoint_location

    def frame(**conf):
        return SimpleNamespace(sparkSession=SimpleNamespace(conf=conf))

    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_location(frame(), StreamConfig("x"))
    assert checkpoint_location(frame(), StreamConfig("x", checkpoint="/c")) == "/c"
    shared = frame(**{"spark.checkpoint.dir": "hdfs://shared/ck"})
    assert checkpoint_location(shared, StreamConfig("x")) == "hdfs://shared/ck/streams/x"


def test_append_list_documents(spark, scratch):
    rows = logtopic(spark, SF_SMALL)
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "lists")
    _write_chunks(spark, rows, src, 2)
    counts = sliding_counts_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"}), 30, 5,
                                   "record_ts", fixed_levels=True)
    q = start(counts, StreamConfig("docs", output_mode="update", available_now=True, checkpoint=os.path.join(scratch, "ck")),
              lambda b, i: append_list_sink(out)(shape.count_documents(b), i))
    run_to_end(q, TIMEOUT)
    got = read_append_list(spark, out)
    recs = parse.parse_log(rows).where(F.col("logType").isin("INFO", "DEBUG", "WARN", "ERROR"))
    docs = shape.count_documents(windows.sliding_count(recs, agg.LEVEL_KEYS, 30, 5))
    assert _same(got, docs.select("key", "tick", "value"))


def test_running_word_count_complete(spark, scratch):
    rows = logtopic(spark, SF_SMALL)
    src = os.path.join(scratch, "src")
    _write_chunks(spark, rows, src, 3)
    q = start(running_word_count_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"})),
              StreamConfig("word_totals", output_mode="complete", available_now=True,
                           checkpoint=os.path.join(scratch, "ck")), fmt="memory")
    run_to_end(q, TIMEOUT)
    batch = agg.word_count(rows, "value").withColumnRenamed("cnt", "total")
    assert _same(spark.table("word_totals"), batch)


def test_events_shaped_stream_source(spark, scratch):
    src = os.path.join(scratch, "ev")
    spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).write.parquet(src)
    q = start(read_log_stream(spark, "parquet", src, events_shaped=True),
              StreamConfig("ev_rows", output_mode="append", available_now=True, checkpoint=os.path.join(scratch, "ck")),
              fmt="memory")
    run_to_end(q, TIMEOUT)
    assert _same(spark.table("ev_rows"), logtopic(spark, SF_SMALL))


def test_kafka_record_normalisation(spark):
    recs = spark.createDataFrame(
        [(None, bytearray(b"h1 svc 2017-01-13 19:57:16,367 INFO x"), "logtopic", 2, 5, dt.datetime(2017, 1, 13, 19, 57, 16))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    r = normalise_kafka(recs).first()
    assert r["value"].startswith("h1 svc") and r["off"] == (2 << 63) + 5


def test_running_count_state_ttl(spark, scratch):
    def run(tag, ttl_ms):
        src, ck, out = (os.path.join(scratch, f"{d}{tag}") for d in ("src", "ck", "out"))

        def tick(lines, at_s):
            log_frame(spark, lines, start_ms=1_000_000 + at_s * 1000).coalesce(1).write.mode("append").parquet(src)
            q = start(running_word_count_ttl_stream(read_log_stream(spark, "parquet", src), ttl_ms, "0 seconds", "record_ts"),
                      StreamConfig(f"ttl_words{tag}", output_mode="update", available_now=True, checkpoint=ck),
                      keyed_upsert_sink(out))
            run_to_end(q, TIMEOUT)
            return {r["word"]: r["total"] for r in read_keyed(spark, out, ["word"]).collect()}

        return [tick(["a b"], 0), tick(["c"], 10), tick(["a a"], 20)]

    short = run("s", 5_000)
    assert short[0] == {"a": 1, "b": 1} and short[1]["c"] == 1
    assert short[2]["a"] == 2      # a expired after 5 s of stream time, starts again
    long = run("l", 3_600_000)
    assert long[2]["a"] == 3       # kept: the total keeps growing


def test_console_sink_runs(spark, scratch):
    from logengine.streaming.sinks import console

    src = os.path.join(scratch, "src")
    log_frame(spark, ["h1 svc 2017-01-13 19:57:16,367 INFO x"]).write.parquet(src)
    counts = sliding_counts_stream(read_log_stream(spark, "parquet", src))
    q = console(counts, num_rows=10).outputMode("update").trigger(availableNow=True) \
        .option("checkpointLocation", os.path.join(scratch, "ck")).start()
    run_to_end(q, TIMEOUT)


def test_write_points_table_payloads(spark, scratch):
    import pytest

    from logengine.operators.points import encode_points
    from logengine.streaming.sinks import line_protocol_sink, write_line_protocol

    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    lines = encode_points(orders, "orders", ["o_custkey", "o_totalprice", "o_orderstatus"], tags=["o_orderpriority"],
                          time_col="o_orderdate")
    out = os.path.join(scratch, "points")
    write_line_protocol(lines, out, "tpch", consistency_level="QUORUM", batch_size=400, buckets=2)
    files = glob.glob(os.path.join(out, "db=tpch", "rp=autogen", "consistency=quorum", "*.txt"))
    assert files
    back = spark.read.text(out).where(F.col("value") != "").select(F.col("value").alias("line"))
    assert _same(back, lines)
    with pytest.raises(ValueError):
        line_protocol_sink(out, "db", consistency_level="sometimes")
    with pytest.raises(ValueError):
        write_line_protocol(lines, out, "db", batch_size=0)


def test_sql_per_tick(spark, scratch):
    from logengine.plans.sql import LEVEL_COUNT_SQL

    rows = logtopic(spark, SF_SMALL)
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    _write_chunks(spark, rows, src, 2)
    recs = parse.parse_log(read_log_stream(spark, "parquet", src))
    q = start(recs, StreamConfig("sql_tick", output_mode="append", available_now=True,
                                 checkpoint=os.path.join(scratch, "ck")),
              foreach_tick(sql_tick(LEVEL_COUNT_SQL, keyed_upsert_sink(out))))
    run_to_end(q, TIMEOUT)
    got = read_keyed(spark, out, agg.LEVEL_KEYS)
    assert _same(got, agg.level_count(parse.parse_log(rows)))


def test_tick_snapshot_put_on_final_windows(spark, scratch):
    """Snapshots need whole windows: append mode + watermark emits each
    window once, when it is final; a later sentinel row closes the last ones."""
    rows = logtopic(spark, SF_SMALL)
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))
    cfg = StreamConfig("snapshots", output_mode="append", available_now=True, checkpoint=ck)

    def run():
        counts = sliding_counts_stream(read_log_stream(spark, "parquet", src), 30, 5, "record_ts",
                                       watermark="0 seconds", fixed_levels=True)
        run_to_end(start(counts, cfg, lambda b, i: keyed_upsert_sink(out)(shape.tick_snapshot(b), i)), TIMEOUT)

    _write_chunks(spark, rows, src, 2)
    run()
    last_ms = rows.agg(F.max(F.unix_millis("record_ts"))).first()[0]
    log_frame(spark, ["h9 svc 2017-01-13 23:00:00,000 INFO sentinel"], start_ms=last_ms + 3_600_000) \
        .write.mode("append").parquet(src)
    run()
    got = read_keyed(spark, out, ["key", "part"])
    recs = parse.parse_log(rows).where(F.col("logType").isin("INFO", "DEBUG", "WARN", "ERROR"))
    expected = shape.tick_snapshot(windows.sliding_count(recs, agg.LEVEL_KEYS, 30, 5))
    assert _same(got.select(expected.columns), expected)


def test_reference_jobs_run(spark, scratch):
    from logengine.streaming import jobs

    rows = logtopic(spark, SF_SMALL)
    src = os.path.join(scratch, "src")
    _write_chunks(spark, rows, src, 3)

    def cfg(name):
        return StreamConfig(name, available_now=True, checkpoint=os.path.join(scratch, "ck-" + name))

    def stream():
        return read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"})

    def run():
        by_record = {"ts_col": "record_ts", "watermark": "2 hours"}
        run_to_end(jobs.key_count_job(stream(), cfg("v1")), TIMEOUT)
        run_to_end(jobs.word_count_job(stream(), cfg("wc")), TIMEOUT)
        run_to_end(jobs.flagship_job(stream(), os.path.join(scratch, "v2"), "logs", cfg("v2"), **by_record), TIMEOUT)
        run_to_end(jobs.documents_job(stream(), os.path.join(scratch, "v3"), cfg("v3"), **by_record), TIMEOUT)
        run_to_end(jobs.latest_level_job(stream(), os.path.join(scratch, "v4"), cfg("v4")), TIMEOUT)
        run_to_end(jobs.snapshot_job(stream(), os.path.join(scratch, "v5"), cfg("v5"), **by_record), TIMEOUT)

    run()
    latest = agg.latest_level(parse.parse_log(rows)).select(F.col("hostName").alias("key"), F.col("logType").alias("value"))
    assert _same(jobs.latest_levels(spark, os.path.join(scratch, "v4")), latest)
    last_ms = rows.agg(F.max(F.unix_millis("record_ts"))).first()[0]
    log_frame(spark, SENTINEL, start_ms=last_ms + 10_800_000).write.mode("append").parquet(src)
    run()
    recs = parse.parse_log(rows)
    assert _same(_lines(spark, os.path.join(scratch, "v2")),
                 shape.count_lines(windows.sliding_count(recs, agg.LEVEL_KEYS, 15, 5)).select("line"))
    four = windows.sliding_count(recs.where(F.col("logType").isin("INFO", "DEBUG", "WARN", "ERROR")), agg.LEVEL_KEYS, 30, 5)
    written = spark.read.parquet(os.path.join(scratch, "v3")).select("key", "tick", "value")
    assert _same(written, shape.count_documents(four).select("key", "tick", "value"))
    snaps = spark.read.parquet(os.path.join(scratch, "v5")).select("key", "part", "value")
    assert _same(snaps, shape.tick_snapshot(four))


def test_sinks_idempotent_on_replay(spark, scratch):
    """A micro-batch replayed after a failure (same batch_id) must not
    duplicate anything in any sink."""
    from logengine.streaming.sinks import line_protocol_sink

    counts = windows.sliding_count(parse.parse_log(logtopic(spark, SF_SMALL)), agg.LEVEL_KEYS, 15, 5)
    lines = shape.count_lines(counts)
    docs = shape.count_documents(counts)
    paths = {k: os.path.join(scratch, k) for k in ("lp", "keyed", "list")}
    for _ in range(2):  # the same batch twice
        line_protocol_sink(paths["lp"], "db")(lines, 4)
        keyed_upsert_sink(paths["keyed"])(counts, 4)
        append_list_sink(paths["list"])(docs, 4)
    back = spark.read.text(paths["lp"]).where(F.col("value") != "")
    assert back.count() == lines.count()
    assert spark.read.parquet(paths["keyed"]).count() == counts.count()
    assert spark.read.parquet(paths["list"]).count() == docs.count()


def test_small_tick_is_one_payload(spark, scratch):
    from logengine.streaming.sinks import write_line_protocol

    lines = shape.count_lines(windows.sliding_count(parse.parse_log(logtopic(spark, SF_SMALL)), agg.LEVEL_KEYS, 15, 5)) \
        .where(F.col("tick") == F.lit(dt.datetime(2017, 1, 13, 20, 0, 0)).cast("timestamp"))
    n = lines.count()
    assert 0 < n < 50
    out = os.path.join(scratch, "one")
    write_line_protocol(lines.select("line"), out, "db", buckets=1)
    payloads = spark.read.text(out, wholetext=True).where(F.length("value") > 0)
    # n newline-terminated lines, plus the text writer's row terminator
    assert payloads.count() == 1 and payloads.first()["value"].count("\n") == n + 1


def test_lines_with_time_are_distinct_points(spark):
    counts = windows.sliding_count(parse.parse_log(logtopic(spark, SF_SMALL)), agg.LEVEL_KEYS, 15, 5)
    lines = shape.count_lines(counts, with_time=True).select("line")
    assert lines.distinct().count() == lines.count() == counts.count()


def test_large_state_store_same_result(spark, scratch):
    from logengine.streaming.runner import LARGE_STATE_CONF

    rows = logtopic(spark, SF_SMALL)
    src = os.path.join(scratch, "src")
    _write_chunks(spark, rows, src, 3)
    before = {k: spark.conf.get(k, None) for k in LARGE_STATE_CONF}
    try:
        for k, v in LARGE_STATE_CONF.items():
            spark.conf.set(k, v)
        q = start(sliding_counts_stream(read_log_stream(spark, "parquet", src, {"maxFilesPerTrigger": "1"}), ts_col="record_ts"),
                  StreamConfig("rocks_counts", output_mode="complete", available_now=True,
                               checkpoint=os.path.join(scratch, "ck")), fmt="memory")
        run_to_end(q, TIMEOUT)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    batch = windows.sliding_count(parse.parse_log(rows), agg.LEVEL_KEYS, 15, 5)
    assert _same(spark.table("rocks_counts"), batch)


def test_points_sink_streams_a_table(spark, scratch):
    """Point batches written from a stream of table files (H3)."""
    from logengine.operators.points import encode_points
    from logengine.streaming.sinks import points_sink

    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    bad = F.col("o_orderkey") % 50 == 0
    orders = orders.withColumn("o_orderpriority", F.when(~bad, F.col("o_orderpriority")))
    n_bad = orders.where(bad).count()
    src, out, left = (os.path.join(scratch, d) for d in ("orders", "points", "rejects"))
    orders.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", "1").parquet(src)

    def encode(df):
        return encode_points(df, "orders", ["o_custkey", "o_totalprice", "o_orderstatus"], tags=["o_orderpriority"],
                             time_col="o_orderdate")

    def rejects(df):
        from logengine.operators.points import invalid_points

        return invalid_points(df, "orders", ["o_custkey", "o_totalprice", "o_orderstatus"], tags=["o_orderpriority"],
                              keep=["o_orderkey"])

    q = start(stream, StreamConfig("points_stream", output_mode="append", available_now=True,
                                   checkpoint=os.path.join(scratch, "ck")),
              points_sink(out, None, lambda df: encode(df).withColumn(
                  "db", F.when(F.col("line").contains("URGENT"), F.lit("hot")).otherwise(F.lit("rest"))),
                  rejects, left, batch_size=1000))
    run_to_end(q, TIMEOUT)
    back = spark.read.text(out).where(F.col("value") != "").select(F.col("value").alias("line"))
    assert _same(back, encode(orders).select("line"))
    assert len(glob.glob(os.path.join(out, "batch_id=*"))) == 3
    hot = spark.read.text(out).where((F.col("value") != "") & (F.col("db") == "hot"))
    assert hot.count() == back.where(F.col("line").contains("URGENT")).count() > 0
    lost = spark.read.parquet(left)
    assert n_bad > 0 and [tuple(r) for r in lost.groupBy("reason").count().collect()] == [("null_tag", n_bad)]
    assert lost.count() + back.count() == orders.count()


def test_kafka_options_offset_policy(spark):
    import pytest

    from logengine.sources.stream import kafka_options

    opts = kafka_options("b1:9092,b2:9092", group_id="logs")
    assert opts == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "logtopic",
                    "startingOffsets": "latest", "kafka.group.id": "logs"}
    # offsets live in the query checkpoint; without the connector jar the
    # source fails at definition time, not silently
    with pytest.raises(Exception, match="(?i)kafka"):
        read_log_stream(spark, "kafka", options=opts)


def test_compact_keyed_state(spark, scratch):
    from logengine.streaming.sinks import compact_keyed

    counts = windows.sliding_count(parse.parse_log(logtopic(spark, SF_SMALL)), agg.LEVEL_KEYS, 15, 5)
    keys = ["tick", *agg.LEVEL_KEYS]
    path, out = os.path.join(scratch, "keyed"), os.path.join(scratch, "compact")
    sink = keyed_upsert_sink(path)
    sink(counts.withColumn("cnt", F.lit(0).cast("long")), 0)   # an older version of every key
    sink(counts.where(F.col("hostName") != "flume-agent-01"), 1)  # newer values for some keys
    before = read_keyed(spark, path, keys)
    newest = compact_keyed(spark, path, keys, out)
    assert newest == 1
    assert len(glob.glob(os.path.join(out, "batch_id=*"))) == 1
    assert _same(read_keyed(spark, out, keys), before)
    # a later batch written to the compacted target still wins
    keyed_upsert_sink(out)(counts.limit(1).withColumn("cnt", F.lit(-1).cast("long")), 2)
    assert read_keyed(spark, out, keys).where(F.col("cnt") == -1).count() == 1


def test_windows_close_on_a_silent_source(spark, scratch):
    """Twenty rows, then silence: every window comes out once, by the clock, and each silent tick
    says so once."""
    src, out, ck = (os.path.join(scratch, d) for d in ("src", "out", "ck"))
    lines = [f"h{i % 2} svc 2017-01-13 19:57:{i:02d},000 INFO x" for i in range(20)]
    log_frame(spark, lines).coalesce(1).write.parquet(src)
    cfg = StreamConfig("silent", trigger_interval="1 second", checkpoint=ck)
    empty, started = [], time.time()
    q = flagship_stream(read_log_stream(spark, "parquet", src), out, "logs", cfg, on_empty=empty.append, with_time=True,
                        length_s=6, slide_s=2)
    try:
        def counts():
            try:
                return [r["line"] for r in _lines(spark, out).collect()]
            except Exception:
                return []

        while time.time() - started < 90 and len(counts()) < 6:
            time.sleep(1)
        got, seen = counts(), len(empty)
        while time.time() - started < 120 and len(empty) < seen + 3:
            time.sleep(1)
        assert q.exception() is None
    finally:
        q.stop()
    # all rows arrive in one micro-batch: three windows of two hosts, ten rows each, nothing twice
    assert sorted(counts()) == sorted(got) and len(got) == 6 == len(set(got))
    assert all("count=10" in line for line in got)
    assert len(empty) >= seen + 3 and len(set(empty)) == len(empty)
