"""Sinks for per-tick results.

All file sinks write through Spark's own writers (any Hadoop file system:
HDFS, object stores) from inside ``foreachBatch`` and key every write by
``batch_id`` with ``overwrite`` on that batch's folder: a replayed
micro-batch (after a failure) rewrites the same folder instead of adding
a second copy, so the sinks are idempotent.

* console            — per-tick preview (``numRows`` rows)
* line protocol      — payloads cut by :func:`write_batches`, partitioned
                       by database / retention policy, optional gzip
* keyed upsert       — last value per key wins (snapshot / latest level)
* append list        — one document per key per tick, history kept
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.operators.batching import DEFAULT_RETENTION_POLICY, bucket_batches, consistency

BatchFn = Callable[[DataFrame, int], None]

BATCH_COL = "batch_id"

#: Parts that the lines of a tick are dealt into by a hash of the line: the
#: same number for any size, so no task holds a whole tick.
SINK_BUCKETS = 8


def _batch_dir(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{BATCH_COL}={batch_id}"


def console(df: DataFrame, num_rows: int = 10, truncate: bool = False):
    """``print()`` per tick: the first ``num_rows`` rows of each micro-batch."""
    return df.writeStream.format("console").option("numRows", num_rows).option("truncate", truncate)


def write_line_protocol(lines: DataFrame, out_dir: str, database: str | None = None,
                        retention_policy: str = DEFAULT_RETENTION_POLICY, consistency_level: str | None = None,
                        batch_size: int = 5000, buckets: int = SINK_BUCKETS, compression: str | None = None) -> None:
    """Write any frame with a ``line`` column as payload files under
    ``out_dir/db=/rp=/consistency=``: payloads of at most ``batch_size``
    lines (ordered by a hash of the row, so repeatable), optional gzip.
    Lines are dealt into ``buckets`` parts per database by their hash, a
    fixed number (1: one payload per database and ``batch_size`` lines).
    ``db`` and ``rp`` columns, where there, win over the literals.
    Used per micro-batch by :func:`line_protocol_sink` and directly for
    whole point tables."""
    level = consistency(consistency_level)
    if "db" not in lines.columns and database is None:
        raise ValueError("lines without a db column need a database")
    keyed = lines.select(
        F.coalesce("db", F.lit(database)).alias("db") if "db" in lines.columns else F.lit(database).alias("db"),
        F.coalesce("rp", F.lit(retention_policy)).alias("rp") if "rp" in lines.columns else F.lit(retention_policy).alias("rp"),
        F.xxhash64(*[F.col(c) for c in lines.columns]).alias("id"),
        "line",
    )
    payloads = bucket_batches(keyed, batch_size=batch_size, buckets=buckets).select(
        "db", "rp", F.lit(level).alias("consistency"), "payload"
    )
    w = payloads.write.mode("overwrite").partitionBy("db", "rp", "consistency")
    if compression:
        w = w.option("compression", compression)
    w.text(out_dir)


def line_protocol_sink(path: str, database: str | None = None, retention_policy: str = DEFAULT_RETENTION_POLICY,
                       consistency_level: str | None = None, batch_size: int = 5000,
                       buckets: int = SINK_BUCKETS, compression: str | None = None) -> BatchFn:
    """``foreachBatch`` body writing a micro-batch's lines as payload files.

    Each micro-batch is cut into payloads of at most ``batch_size`` lines
    (the count half of "flush at N points or every interval"; the
    interval is the trigger). ``compression="gzip"`` gzips payload files.
    """
    consistency(consistency_level)  # reject a bad level before the stream starts

    def write(batch: DataFrame, batch_id: int) -> None:
        write_line_protocol(batch, _batch_dir(path, batch_id), database, retention_policy, consistency_level,
                            batch_size, buckets, compression)

    return write


def points_sink(path: str, database: str | None, encode: Callable[[DataFrame], DataFrame],
                rejects: Callable[[DataFrame], DataFrame] | None = None, rejects_path: str | None = None,
                **kwargs) -> BatchFn:
    """``foreachBatch`` body for point batches: ``encode`` turns the batch
    into ``line`` rows (e.g. :func:`logengine.operators.points.encode_points`),
    each with its own ``db`` / ``rp`` if it has these columns. ``rejects``
    (e.g. :func:`logengine.operators.points.invalid_points` with the same
    arguments) names the rows left out; they are written under
    ``rejects_path``, keyed by batch like the points."""
    if (rejects is None) != (rejects_path is None):
        raise ValueError("rejects and rejects_path go together")
    sink = line_protocol_sink(path, database, **kwargs)

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = encode(batch)
        sink(lines.select(*[c for c in ("db", "rp", "line") if c in lines.columns]), batch_id)
        if rejects is not None:
            rejects(batch).write.mode("overwrite").parquet(_batch_dir(rejects_path, batch_id))

    return write


def read_latest(spark: SparkSession, path: str, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """State of a keyed target whose rows carry their own order (such as
    arrival time and offset): the greatest per key wins, whichever batch
    wrote it, so a late row never replaces a newer one."""
    df = spark.read.parquet(path)
    values = [c for c in df.columns if c not in (*key_cols, BATCH_COL)]
    latest = df.groupBy(*key_cols).agg(F.max_by(F.struct(*values), F.struct(*order_cols)).alias("_v"))
    return latest.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in values])


def keyed_upsert_sink(path: str) -> BatchFn:
    """``foreachBatch`` body for a keyed target: each batch's rows are
    stored under its ``batch_id``; :func:`read_keyed` resolves the last
    value per key. Works for any row shape."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_dir(path, batch_id))

    return write


def read_keyed(spark: SparkSession, path: str, key_cols: Sequence[str]) -> DataFrame:
    """Current state of a keyed target: latest batch's row per key
    (partial aggregate per key; no driver-side merge)."""
    df = spark.read.parquet(path)
    values = [c for c in df.columns if c not in (*key_cols, BATCH_COL)]
    latest = df.groupBy(*key_cols).agg(F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("_v"))
    return latest.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in values])


def compact_keyed(spark: SparkSession, path: str, key_cols: Sequence[str], out_path: str) -> int:
    """Write the current state of a keyed target as one snapshot batch
    under ``out_path`` (keyed by the newest batch id, so later batches
    appended there still win). Reading state then costs one folder instead
    of the whole history. Nothing under ``path`` is changed; returns the
    snapshot's batch id (one scalar to the driver)."""
    newest = spark.read.parquet(path).agg(F.max(BATCH_COL)).first()[0]
    read_keyed(spark, path, key_cols).write.mode("overwrite").parquet(_batch_dir(out_path, newest))
    return newest


def append_list_sink(path: str) -> BatchFn:
    """``foreachBatch`` body appending ``(key, tick, value)`` documents."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("key", "tick", "value").write.mode("overwrite").parquet(_batch_dir(path, batch_id))

    return write


def read_append_list(spark: SparkSession, path: str) -> DataFrame:
    """``(key, tick, value)``: each key's documents, one row each; ordered by
    tick they are what a right-push list would hold. A window re-emitted
    by a later batch (update mode) keeps its last version. Rows, not one
    collected list per key: a key's history grows without bound."""
    df = spark.read.parquet(path)
    return df.groupBy("key", "tick").agg(F.max_by("value", F.col(BATCH_COL)).alias("value"))
