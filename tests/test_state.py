"""State of streams: carried totals, state as a table, counts per tick."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from logengine.operators import aggregate as agg
from logengine.operators import parse
from logengine.sources.logtopic import logtopic
from logengine.sources.stream import read_log_stream
from logengine.streaming import state
from logengine.streaming.runner import LARGE_STATE_CONF, StreamConfig, key_count_stream, run_to_end, running_word_count_stream, start

from .conftest import SF_SMALL, log_frame

TIMEOUT = 180


@pytest.fixture
def rocksdb(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE_STATE_CONF}
    for k, v in LARGE_STATE_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_known_words_are_carried_forward_until_they_expire(spark, scratch, rocksdb):
    src, ck = os.path.join(scratch, "src"), os.path.join(scratch, "ck")
    got: list = []

    def tick(lines, at_s):
        log_frame(spark, lines, start_ms=1_000_000 + at_s * 1000).coalesce(1).write.mode("append").parquet(src)
        got.clear()
        stream = state.carry_forward_stream(read_log_stream(spark, "parquet", src), 5_000, 60_000, "0 seconds", "record_ts")
        q = start(stream, StreamConfig("carried", output_mode="update", available_now=True, checkpoint=ck),
                  lambda batch, _: got.extend(tuple(r) for r in batch.collect()))
        run_to_end(q, TIMEOUT)  # every tick is a run of its own: state and timers come from the checkpoint
        return set(got)

    assert tick(["a b a"], 0) == {("a", 2, True), ("b", 1, True)}
    assert tick(["c"], 10) == {("c", 1, True), ("a", 2, False), ("b", 1, False)}
    assert tick(["a"], 20) == {("a", 3, True), ("b", 1, False), ("c", 1, False)}
    assert tick(["d"], 79) >= {("d", 1, True), ("a", 3, False)}
    last = tick(["b"], 200)  # all known words but those of this tick are over their time
    assert ("a", 3, False) not in last and ("c", 1, False) not in last
    assert tick(["a"], 201) >= {("a", 1, True)}


def test_totals_are_read_out_of_the_checkpoint(spark, scratch):
    rows = logtopic(spark, SF_SMALL)
    cut = rows.agg(F.percentile_approx("off", 0.5)).first()[0]
    src, ck = os.path.join(scratch, "src"), os.path.join(scratch, "ck")

    def run(part):
        part.write.mode("append").parquet(src)
        q = start(running_word_count_stream(read_log_stream(spark, "parquet", src)),
                  StreamConfig("state_totals", output_mode="complete", available_now=True, checkpoint=ck), fmt="noop")
        run_to_end(q, TIMEOUT)
        return q.lastProgress.batchId

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    def totals(of):
        return agg.word_count(of, "value").withColumnRenamed("cnt", "total")

    half = rows.where(F.col("off") < cut)
    first = run(half)
    assert same(state.running_totals(spark, ck), totals(half))
    run(rows.where(F.col("off") >= cut))  # a restart from the same checkpoint
    assert same(state.running_totals(spark, ck), totals(rows))
    assert same(state.running_totals(spark, ck, batch_id=first), totals(half))


def test_ticks_tell_what_they_read_rejected_and_dropped(spark, scratch):
    src, ck = os.path.join(scratch, "src"), os.path.join(scratch, "ck")
    line = "h{} svc 2017-01-13 19:57:16,367 INFO x"

    def tick(lines, at_s):
        log_frame(spark, lines, start_ms=1_000_000_000 + at_s * 1000).coalesce(1).write.mode("append").parquet(src)
        rows = parse.observe_rows(read_log_stream(spark, "parquet", src), "rows")
        q = start(key_count_stream(rows, "record_ts", "10 seconds"),
                  StreamConfig("told", output_mode="append", available_now=True, checkpoint=ck), fmt="noop")
        run_to_end(q, TIMEOUT)
        sums = {}
        for m in state.tick_metrics(q, "rows"):
            for k, v in m.items():
                sums[k] = sums.get(k, 0) + v
        del sums["batch_id"]
        return sums

    assert tick([line.format(1), "\tat some.Call(x)", "a INFO"], 100) == {
        "rows_read": 3, "no_level_marker": 1, "too_few_tokens": 1, "late": 0}
    assert tick([line.format(1)], 200)["late"] == 0
    assert tick([line.format(1), line.format(2), line.format(3)], 0) == {
        "rows_read": 3, "no_level_marker": 0, "too_few_tokens": 0, "late": 3}
