"""State of running queries: totals that known keys carry forward on timers, state read as a table
out of a checkpoint, and what each tick read, rejected and dropped."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from logengine.streaming.runner import ARRIVAL, _word_batches


class CarryForward(StatefulProcessor):
    """A running total per word, emitted when the word is seen and again every ``tick_ms`` of stream
    time while it is not, until ``ttl_ms`` after it was last seen (None: for ever). State is the
    total, the word's last time and its one pending timer."""

    def __init__(self, tick_ms: int, ttl_ms: int | None):
        self.tick_ms, self.ttl_ms = tick_ms, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "total long, last_ms long, timer_ms long")

    def _keep(self, key, total: int, last: int, timer: int, seen: bool):
        import pandas as pd

        self.handle.registerTimer(timer)
        self.known.update((total, last, timer))
        return pd.DataFrame({"word": [key[0]], "total": [total], "seen": [seen]})

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        total, last, timer = self.known.get() if self.known.exists() else (0, 0, None)
        if timer is not None:
            self.handle.deleteTimer(timer)
        for pdf in rows:
            total += int(pdf["n"].sum())
            last = max(last, int(pdf["ms"].max()))
        now = max(last, int(timerValues.getCurrentWatermarkInMs()))
        yield self._keep(key, total, last, now + self.tick_ms, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        total, last, _ = self.known.get()
        now = max(int(timerValues.getCurrentWatermarkInMs()), int(expiredTimerInfo.getExpiryTimeInMs()))
        if self.ttl_ms is not None and now >= last + self.ttl_ms:
            self.known.clear()
            return
        yield self._keep(key, total, last, now + self.tick_ms, False)


def carry_forward_stream(rows: DataFrame, tick_ms: int = 5000, ttl_ms: int | None = None,
                         watermark: str | None = None, ts_col: str = ARRIVAL) -> DataFrame:
    """``(word, total, seen)`` in output mode ``update``: the words of a tick with their running
    total, and the known words that a tick lacks with the total they had (``seen`` false), in place
    of re-emitting the whole state by ``complete`` mode. Words are counted before the shuffle.

    Timers run on the stream's event time (``ts_col`` with ``watermark``), so that expiry does not
    depend on the machine and an ``availableNow`` run ends. Needs the RocksDB state store
    (:data:`logengine.streaming.runner.LARGE_STATE_CONF`)."""
    if tick_ms <= 0 or (ttl_ms is not None and ttl_ms <= 0):
        raise ValueError("tick_ms and ttl_ms must be positive")
    return _word_batches(rows, ts_col, watermark).groupBy("word").transformWithStateInPandas(
        CarryForward(tick_ms, ttl_ms), "word string, total long, seen boolean", "Update", "EventTime"
    )


def state_table(spark: SparkSession, checkpoint: str, operator_id: int = 0, batch_id: int | None = None) -> DataFrame:
    """The state of a query as a table: the fields of its keys and values, and ``partition_id``.
    Read from the checkpoint, partition by partition, while the query runs or after it; by default
    as of its last committed batch."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "value.*", "partition_id")


def running_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``(word, total)`` out of the checkpoint of
    :func:`logengine.streaming.runner.running_word_count_stream`: the totals as of a batch, without
    reading any row again."""
    return state_table(spark, checkpoint, batch_id=batch_id).select("word", F.col("count").alias("total"))


def tick_metrics(query: StreamingQuery, name: str) -> list[dict]:
    """One entry per recent micro-batch of a query over
    :func:`logengine.operators.parse.observe_rows` rows: ``batch_id``, the observed counts, and
    ``late``, the state entries (window and key) that came behind the watermark and were dropped.
    Batches that read no row count zero. Comes with the query's progress, as many batches as
    Spark keeps (``spark.sql.streaming.numRecentProgressUpdates``)."""
    out = []
    for p in query.recentProgress:
        row = p.observedMetrics.get(name)
        seen = row.asDict() if row is not None else {"rows_read": 0, "no_level_marker": 0, "too_few_tokens": 0}
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        out.append({"batch_id": p.batchId, **seen, "late": late})
    return out
