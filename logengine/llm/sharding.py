"""Proportional stratified interleaving into shards.

The rows of each source are shuffled by a seeded hash and ranked; a row's fractional rank
(2 r - 1) / 2 n says how far it is through its source. All rows in the order of fractional rank
interleave the sources in proportion, and equal cuts of that order are shards that all match the
mixture, with row counts at most one apart (the law ``rows``).

Both rankings are made cell by cell (a cell is a range of the hash or of the fraction, so all
cells are alike in size, whatever the sources), from counts of cells; only ids and hashes are
shuffled, never texts.

Defined results: null text has size 16 and the checksum of no bytes; a null source is a source of
its own; equal rows are alike, so it doesn't matter which comes first; an empty table gives an
empty result; other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import (
    RANK_BUCKETS,
    cell_counts,
    checkpointed,
    ranked,
    seed_bucket,
    seeded,
    source_key,
    text_bytes,
)

SHARDS = 40
SEED = 7_205_759
#: Bytes that each row counts beside its text.
ROW_BYTES = 16


def described(docs: DataFrame) -> DataFrame:
    """``docs`` without its text: ``size`` and ``text_crc32`` stand for it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [c for c in docs.columns if c not in {"text", "size", "text_crc32"}]
    return docs.select(
        *own, (text_bytes(F.col("text")) + ROW_BYTES).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    )


def shard(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, buckets: int = RANK_BUCKETS) -> DataFrame:
    """``rows`` (doc_id, source, text_crc32, ...) with ``shard`` and ``slot`` (its place there)."""
    own = [c for c in rows.columns if c not in {"shard", "slot"}]
    keyed = rows.select(
        *own, source_key(F.col("source")).alias("_source"),
        seeded(seed, F.col("doc_id"), F.col("text_crc32")).alias("_seeded"),
    ).withColumn("_bucket", seed_bucket(F.col("_seeded"), buckets))
    tie = [F.col("_seeded"), F.col("doc_id"), F.col("text_crc32")]
    cells = cell_counts(keyed, ["_source"], "_bucket")
    strata = checkpointed(ranked(keyed, cells, ["_source"], "_bucket", tie, "_r").drop("_bucket"))
    odd, twice = 2 * F.col("_r") - 1, 2 * F.col("_r_of")
    placed = strata.select(
        "*", F.lit(0).alias("_all"), (odd / twice).alias("_fraction"),
        F.expr(f"(2 * _r - 1) * {buckets} div (2 * _r_of)").alias("_bucket"),
    )
    cells = cell_counts(placed, ["_all"], "_bucket")  # at most one row for each cell
    order = [F.col("_fraction"), F.col("_source"), *tie]
    at = ranked(placed, cells, ["_all"], "_bucket", order, "_g").withColumn(
        "_shard", F.expr(f"(_g - 1) * {shards} div _g_of")
    )
    first = F.expr(f"(_shard * _g_of + {shards - 1}) div {shards}")
    return at.select(*own, F.col("_shard").cast("int").alias("shard"), (F.col("_g") - 1 - first).alias("slot"))
