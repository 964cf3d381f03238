"""Pipeline stages: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logengine.llm import bpe, mixing, passages, quality, simhash
from logengine.llm.common import DOCUMENT_COLUMNS, checkpointed, row_id, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Texts are measured once and written beside their
    figures: the sketches read the figures alone, and no text is shuffled."""
    measured = written(quality.measure(docs.select(*DOCUMENT_COLUMNS)))
    limits = checkpointed(quality.thresholds(checkpointed(quality.sketches(measured))))
    return quality.judge(measured, limits).where("kept").select(*DOCUMENT_COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one whose id names it (of rows that repeat
    this id, the first by text hash). Rows without an id count as documents whose id comes after
    all others; those with equal texts as one document."""
    docs = docs.select(*DOCUMENT_COLUMNS).withColumn("_row", row_id(F.col("doc_id"), F.col("text")))
    found = simhash.near_duplicates(
        docs.select(F.col("_row").alias("doc_id"), "text"), simhash.SHINGLE_WORDS, simhash.MAX_BITS
    )
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_row"))
    own = Window.partitionBy("_row").orderBy(F.xxhash64("text"), "lang", "source")
    kept = docs.join(first, "_row", "left_semi").withColumn("_at", F.row_number().over(own)).where("_at = 1")
    return kept.select(*DOCUMENT_COLUMNS)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has too; rows without an id come
    last, and those with equal texts are one document."""
    own = F.col("doc_id")
    docs = docs.select(row_id(own, F.col("text")).alias("doc_id"), own.alias("_doc_id"), *DOCUMENT_COLUMNS[1:])
    left = passages.without_passages(docs, passages.passages(docs))
    return left.select(F.col("_doc_id").alias("doc_id"), *DOCUMENT_COLUMNS[1:])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs.select(*DOCUMENT_COLUMNS)).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*DOCUMENT_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, with the bytes they decode to. The workers that earlier
    stages have used remember fewer pre-tokens: an executor holds all stages' leftovers."""
    return bpe.encode_documents(docs.select("doc_id", "text"), memory=60_000)
