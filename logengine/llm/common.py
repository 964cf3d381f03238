"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logengine.session import checkpoint_dir

#: White space between words: U+0020 and U+0009 to U+000D (what ``bytes.split()`` splits at).
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Buckets that a distributed ranking cuts one order into; one row for each is all
#: that a single task sees of the whole.
RANK_BUCKETS = 4096

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table of ``sf_dir``, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null or blank text: empty)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def n_words(text: Column) -> Column:
    """Number of words of a text, without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: 0)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key without nulls that sorts as the source does by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def seeded(seed: int, *columns: Column) -> Column:
    """A uniform non-negative 63-bit number that depends on the seed and the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def seed_bucket(number: Column, buckets: int = RANK_BUCKETS) -> Column:
    """Order-preserving bucket of a :func:`seeded` number."""
    return F.floor(number / F.lit(float(2**63)) * buckets).cast("int")


def cell_counts(df: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Rows of each (keys, bucket) cell as ``_n``, counted in part before the shuffle."""
    return df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))


def ranked(df: DataFrame, cells: DataFrame, keys: list[str], bucket: str, order: list[Column], out: str) -> DataFrame:
    """Rank (from 1) of each row within ``keys``, in the order of (``bucket``, ``order``), with
    the rows of its group as ``{out}_of`` and the columns that ``cells`` has beside its counts.

    ``bucket`` is a column that rises with the order and deals a group out evenly; ``cells`` are
    its :func:`cell_counts`. Each cell is numbered in its own task and shifted by the rows of the
    cells before it, so a key that holds most rows is not ranked in one task. Keys hold no nulls.
    """
    group = Window.partitionBy(*keys)
    before = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
        f"{out}_of", F.sum("_n").over(group)
    )
    own = Window.partitionBy(*keys, bucket).orderBy(*order)
    joined = df.join(cells.drop("_n"), [*keys, bucket])
    return joined.withColumn(out, F.col("_before") + F.row_number().over(own)).drop("_before")


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder of ``spark.checkpoint.dir``, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_WRITTEN: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """The frame written once as Parquet in the shared folder, so that each reader takes the columns
    it needs; :func:`remove_written` clears what is no longer read."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def remove_written(spark: SparkSession) -> None:
    while _WRITTEN:
        remove(spark, _WRITTEN.pop())


def row_id(doc_id: Column, text: Column) -> Column:
    """The id, or where there is none one that equal texts share and that is after all usual ids."""
    return F.coalesce(doc_id.cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gives its worker's unused memory back when its task ends;
    workers are reused, and what an idle one holds counts against its executor."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()

    return wrapped


def extended(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    """A copy of a schema with more fields at its end."""
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])
