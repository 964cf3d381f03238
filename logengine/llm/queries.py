"""Registered queries of the corpus operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logengine.llm import (
    bpe, chat, classifier, lzfingerprint, merkle, mixing, oracle_merkle, oracle_quality, oracle_spelling, packing, passages, quality,
    sharding, simhash, spelling, urlfilter,
)
from logengine.llm.common import DOCUMENT_COLUMNS, checkpointed, n_words, read


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation and of one that holds control strings."""
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.format_digests(turns.unionByName(more))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    measured = checkpointed(quality.measure(docs).drop("text"))
    limits = checkpointed(quality.thresholds(checkpointed(quality.sketches(measured))))
    return quality.judge(measured, limits).select("doc_id", *quality.LONGS, "base_failed", "kept")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, listed rule and verdict of every page's url."""
    return urlfilter.judge(read(spark, sf_dir, "pages", "page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "learned", "confidence"
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that a document shares with an earlier one."""
    return passages.passages(read(spark, sf_dir, "documents", "doc_id", "text")).drop("text_hash")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts at most one apart."""
    rows = checkpointed(sharding.described(read(spark, sf_dir, "documents", "doc_id", "text", "source")))
    return sharding.shard(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, beside its source's size and target."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    sized = checkpointed(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"))
    )
    return mixing.mix_sized(sized).select("doc_id", "size", "source_size", "target", "taken")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded bytes of every document."""
    return bpe.encoding_digests(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return lzfingerprint.with_next(read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = classifier.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return classifier.score(docs, model).select(
        "doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what its (partly tampered) leaf folds to."""
    docs = read(spark, sf_dir, "documents", *DOCUMENT_COLUMNS)
    changed = F.when(merkle.tampered(F.col("doc_id")), merkle.document_leaf(merkle.lowered(F.col("text"))))
    leaves = docs.select("doc_id", "source", merkle.document_leaf().alias("leaf"), changed.alias("claim"))
    return merkle.manifest(leaves, claim="claim").drop("source")


def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    return packing.pack(checkpointed(packing.encoded(read(spark, sf_dir, "documents", "doc_id", "text"))))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its form, the root of its forms and its number of near words."""
    return spelling.variants(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filters": op3_url_filters,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_lz_fingerprint": op9_lz_fingerprint,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_sequence_packing": op12_sequence_packing,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": oracle_quality.OP2,
    "op11_merkle_manifest": oracle_merkle.OP11,
    "op13_spelling_variants": oracle_spelling.OP13,
}
