"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental (LZ78) dictionary: each phrase is the longest
one known so far and one character more. The phrase set is hashed into a minimum-hash signature,
so the share of equal positions estimates how many phrases two texts have in common: texts that
would compress well together are alike. The signature of a union is the minimum of signatures, so
an edit at the end reuses the parse of what stays before it.

:func:`with_next` compares each text with its neighbour in ascending order of doc_id and with an
edited text that ends like the neighbour. Rows are dealt into id ranges (bounds from quantiles),
each range also gets the first rows of the next one, and a task reads its ranges in order with
two texts in memory; texts are shuffled once and no task or driver sees the whole order.

Defined results: null text is the empty text, whose signature is all ones; equal texts have equal
fingerprints; a null doc_id comes before all others; rows that repeat a doc_id come in the order
of their text; a single row is its own neighbour; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Positions of a signature; each keeps 16 bits of its least hash.
POSITIONS = 128
#: Phrases hashed at once.
_CHUNK = 4096
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _spread(n: int) -> np.ndarray:
    """Odd 64-bit multipliers from a counter (mixed by multiplication and shifts)."""
    x = (np.arange(1, n + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


_BY = _spread(POSITIONS)


def parse(text: str, at: int, known: set[str]) -> tuple[int, list[str]]:
    """Phrases of ``text`` from ``at`` on that are added to ``known``, and where the last,
    incomplete phrase begins.

    The known phrases hold all prefixes of each other, so the search for the longest known one
    can start from three characters and go up or down."""
    n, added = len(text), []
    while at < n:
        phrase = text[at : at + 3]
        if phrase in known:
            size = 3
            while phrase in known:
                if at + size >= n:
                    return at, added  # the rest is known
                size += 1
                phrase = text[at : at + size]
        else:
            shorter = text[at : at + 2]
            if shorter not in known:
                phrase, shorter = shorter, text[at]
                if shorter not in known:
                    phrase = shorter
        known.add(phrase)
        added.append(phrase)
        at += len(phrase)
    return at, added


def least_hashes(phrases: list[str], so_far: np.ndarray | None = None) -> np.ndarray:
    """Minimum of each of ``POSITIONS`` hashes over the phrases."""
    least = np.full(POSITIONS, 0xFFFFFFFFFFFFFFFF, np.uint64) if so_far is None else so_far
    digest = xxhash.xxh3_64_intdigest
    for at in range(0, len(phrases), _CHUNK):
        part = phrases[at : at + _CHUNK]
        hashes = np.fromiter((digest(p.encode()) for p in part), np.uint64, len(part))
        least = np.minimum(least, (_BY[:, None] * hashes[None, :]).min(axis=1))
    return least


def signature(text: str | None) -> np.ndarray:
    return least_hashes(parse(text or "", 0, set())[1])


def fingerprint(least: np.ndarray) -> str:
    return (least >> np.uint64(16) & np.uint64(0xFFFF)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal positions of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(f), ">u2") for f in (a, b))
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


class _Parsed:
    """A text, its fingerprint and what an edit of its last quarter needs."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        head = self.text[: len(self.text) - len(self.text) // 4]
        known: set[str] = set()
        self.at, added = parse(head, 0, known)
        self.head = least_hashes(added)
        self.known = known
        full = least_hashes(parse(self.text, self.at, set(known))[1], self.head)
        self.fingerprint = fingerprint(full)

    def row(self, following: _Parsed) -> tuple:
        new = edited(self.text, following.text)
        changed = fingerprint(least_hashes(parse(new, self.at, self.known)[1], self.head))
        return (
            self.doc_id, len(self.text), hashlib.sha256(new.encode()).hexdigest(), self.fingerprint, changed,
            likeness(self.fingerprint, changed), likeness(self.fingerprint, following.fingerprint),
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(signature(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (range, extra, doc_id, text) in order: each row with the one after it."""
    out: list[tuple] = []
    at, before, closed = None, None, False
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def batch() -> pa.RecordBatch:
        made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(made, names)

    for b in batches:
        for i in range(len(b)):
            part, extra, doc_id = (b.column(k)[i].as_py() for k in range(3))
            if part != at:
                at, before, closed = part, None, False
            if closed:
                continue  # other rows of the id that the next range begins with
            row = _Parsed(doc_id, b.column(3)[i].as_py())
            if before is not None:
                out.append(before.row(row))
            before, closed = row, bool(extra)
            if len(out) >= 1000:
                yield batch()
    if out:
        yield batch()


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every row's fingerprint and that of its edited text, and their likeness to each other and to
    the next document's."""
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.col("doc_id").cast("long"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_key"),
    )
    parts = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    bounds = keyed.agg(F.percentile_approx("_key", parts, 100 * ranges)).first()[0] if ranges > 1 else []
    bounds = sorted(set(bounds or []))
    cut = F.array(*(F.lit(b) for b in bounds)).cast("array<long>")
    dealt = keyed.withColumn("_range", F.size(F.filter(cut, lambda b: b <= F.col("_key"))))
    # The first id of each range (one number for each) also closes the range before it, round the end.
    firsts = [tuple(r) for r in dealt.groupBy("_range").agg(F.min("_key")).orderBy("_range").collect()]
    closes = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    also = F.create_map(*(F.lit(x) for kv in closes.items() for x in kv)) if closes else F.lit(None)
    places = F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("e")))
    if closes:
        places = F.when(
            F.col("_key").isin(list(closes)),
            F.concat(places, F.array(F.struct(also[F.col("_key")].alias("r"), F.lit(1).alias("e")))),
        ).otherwise(places)
    rows = dealt.select("_key", "doc_id", "text", F.explode(places).alias("p"))
    return (
        rows.select(F.col("p.r").alias("r"), F.col("p.e").alias("e"), "_key", "doc_id", "text")
        .repartition("r")
        .sortWithinPartitions("r", "e", "_key", "text")
        .select("r", "e", "doc_id", "text")
        .mapInArrow(_neighbours, _SCHEMA)
    )
