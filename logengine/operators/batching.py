"""Cut encoded points into write batches.

Points are grouped by (database, retention policy), both of them keys
(the reference joined them with ``_``, which can collide), and cut in id
order into batches of at most ``batch_size`` points, one
newline-terminated payload each. Numbers come from
:mod:`logengine.operators.numbering`, so a hot database is spread over
many tasks and the cut never depends on partitioning or size; the
byte-only forms shuffle sizes and hashes, never texts.

For small frequent batches (a tick) ``buckets`` cuts by a hash of the line
instead, a fixed number of parts per database, without looking at the data
first. A null line is an error: every point counted is in a payload.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logengine.operators.greedy import greedy_batches
from logengine.operators.numbering import ordinal_within, positions
from logengine.session import checkpoint_dir

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
# Largest payload the datagram path takes (bytes).
DATAGRAM_LIMIT = 65535
DEFAULT_RETENTION_POLICY = "autogen"
DEFAULT_CONSISTENCY = "one"
CONSISTENCY_LEVELS = ("all", "any", "one", "quorum")
# ---------------------------------------------------------------------------

GROUP = ["db", "rp"]


def consistency(level: str | None) -> str:
    lv = (level or DEFAULT_CONSISTENCY).lower()
    if lv not in CONSISTENCY_LEVELS:
        raise ValueError(f"consistency must be one of {CONSISTENCY_LEVELS}")
    return lv


def _line() -> Column:
    return F.coalesce("line", F.raise_error(F.lit("a point has no line")).cast("string"))


def _tie(line: Column) -> Column:
    """Orders points of one id: the first 60 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def _check(batch_size: int) -> None:
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")


def _sizes(lines: DataFrame, id_col: str) -> DataFrame:
    """``(db, rp, id, _tie, n)``: all that numbering and byte sums need."""
    return lines.select(
        *GROUP, F.col(id_col).alias("id"), _tie(_line()).alias("_tie"),
        (F.octet_length(_line()) + F.lit(1)).cast("long").alias("n"),
    )


def _written(sizes: DataFrame) -> DataFrame:
    """The sizes as Parquet in the shared folder: numbering reads them four times (or the ids
    alone), and each time would encode and hash every line anew."""
    path = f"{checkpoint_dir(sizes.sparkSession).rstrip('/')}/sizes-{uuid.uuid4().hex}"
    sizes.write.parquet(path)
    return sizes.sparkSession.read.schema(sizes.schema).parquet(path)


def _payloads(numbered: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    return numbered.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sum(F.octet_length("line") + F.lit(1)).alias("n_bytes"),
        F.concat(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(id_col, "line"))), lambda x: x["line"]), "\n"),
            F.lit("\n"),
        ).alias("payload"),
    )


def write_batches(lines: DataFrame, batch_size: int = 5000, id_col: str = "id") -> DataFrame:
    """``(db, rp, batch_no, n_points, n_bytes, payload)`` from ``(db, rp,
    id, line)``: exactly ``batch_size`` points each but for the last of a
    (db, rp). Lines keep id order inside a payload."""
    _check(batch_size)
    tied = lines.withColumn("line", _line()).withColumn("_tie", _tie(F.col("line")))
    numbered = ordinal_within(tied, GROUP, [id_col, "_tie"], out_col="_at", lead=1)
    numbered = numbered.withColumn("batch_no", F.floor(F.col("_at") / F.lit(batch_size)).cast("int"))
    return _payloads(numbered, [*GROUP, "batch_no"], id_col)


def bucket_batches(lines: DataFrame, batch_size: int = 5000, buckets: int = 8, id_col: str = "id") -> DataFrame:
    """``(db, rp, bucket, batch_no, n_points, n_bytes, payload)``: like
    :func:`write_batches` within each of a fixed number of hash buckets of
    the line; one shuffle, no pass over the data beforehand."""
    _check(batch_size)
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    dealt = lines.withColumn("line", _line()).withColumn(
        "bucket", F.pmod(F.xxhash64("line"), F.lit(buckets)).cast("int"))
    w = Window.partitionBy(*GROUP, "bucket").orderBy(id_col, "line")
    numbered = dealt.withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / F.lit(batch_size)).cast("int"))
    return _payloads(numbered, [*GROUP, "bucket", "batch_no"], id_col)


def oversize_batches(lines: DataFrame, batch_size: int = 5000, id_col: str = "id", limit: int = DATAGRAM_LIMIT) -> DataFrame:
    """``(db, rp, batch_no, n_points, n_bytes, oversize)`` of the batches of
    :func:`write_batches`, without building payloads or moving lines."""
    _check(batch_size)
    numbered = ordinal_within(_sizes(lines, id_col), GROUP, ["id", "_tie"], out_col="_at", lead=1)
    return (
        numbered.groupBy(*GROUP, F.floor(F.col("_at") / F.lit(batch_size)).cast("int").alias("batch_no"))
        .agg(F.count(F.lit(1)).alias("n_points"), F.sum("n").alias("n_bytes"))
        .withColumn("oversize", F.col("n_bytes") > F.lit(limit))
    )


def byte_batches(lines: DataFrame, limit: int = DATAGRAM_LIMIT, id_col: str = "id") -> DataFrame:
    """``(db, rp, batch_no, n_points, n_bytes)``: payloads cut by size in id
    order, each as long as the limit allows (lines newline-terminated): a
    payload takes lines until the next one no longer fits, which gives the
    fewest payloads, whatever the longest line is. See
    :mod:`logengine.operators.greedy` for how that is done in parallel. Lines
    are encoded once, their sizes written to ``spark.checkpoint.dir``. A
    line longer than ``limit`` on its own fails the job, as a datagram could
    not carry it."""
    sizes = _written(_sizes(lines, id_col))
    placed = positions(sizes, GROUP, ["id", "_tie"], out_col="_at", size_col="n", lead=1)
    return greedy_batches(placed, GROUP, limit)
