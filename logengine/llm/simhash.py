"""SimHash near-duplicates by pigeonhole blocks.

Each text gets a 64-bit majority fingerprint of its word shingles. Fingerprints that differ in
at most ``max_bits`` bits agree on at least one of ``max_bits + 1`` blocks, so distinct
fingerprints are joined on (block, value) and verified by Hamming distance. A cell that holds
more than ``cell_limit`` fingerprints is cut again by the same argument on the bits that it has
not fixed yet; results don't depend on the limit. Inside a cell the close fingerprints are found
by a search that removes what it has reached, so it emits a spanning tree of each cluster, never
all pairs, and a dense cluster costs little more than its size. The trees of all cells are joined
into components by alternating star contraction.

Defined results: null or blank text has fingerprint zero, which links like any other; equal texts
have equal fingerprints; rows that repeat a doc_id are one document; a null doc_id never names a
component (a component of null ids only has a null id); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import checkpointed, tidy

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one cell that a task compares without cutting the cell again.
CELL_LIMIT = 16_384
#: Times that a large cell is cut again.
MAX_CUTS = 2
#: Up to so many, all distances of a cell are taken at once.
_DENSE = 256
_CHUNK = 16_384

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, size: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of the text (A-Z lower-cased, repeats included)."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined, size = b" ".join(words), min(size, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends][: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[size - 1 :], strict=True)), np.uint64, len(starts)
    )


def fingerprint(text: str | None, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 bits, each set if it is set in over half of the shingle hashes."""
    hashes = shingle_hashes(text, size, seed)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), size, seed) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "doc_id long, fp long")


def split_mask(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` dealt into ``parts`` blocks of neighbouring bits, as masks."""
    bits = [b for b in range(64) if free >> b & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def spanning_links(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Positions (i, j) of a spanning forest of the graph of fingerprints at most ``max_bits`` apart."""
    links: list[tuple[int, int]] = []
    if len(fp) <= _DENSE:
        near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= max_bits
        if int(near.sum()) == len(fp):
            return links
    left = np.arange(len(fp))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            close = np.bitwise_count(fp[left] ^ fp[at]) <= max_bits
            if close.any():
                reached = left[close]
                links.extend((int(at), int(x)) for x in reached)
                queue.extend(reached)
                left = left[~close]
    return links


def _cell_links(max_bits: int):
    """For partitions sorted by (mask, part): links of each cell, held one cell at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the cell that the last batch ended in: rows of (mask, part, fp, rep)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            out: list[tuple[int, int]] = []
            for a, z in zip([0, *cut], [*cut, len(rows)], strict=True):
                if z - a > 1:
                    rep = rows[a:z, 3]
                    for i, j in spanning_links(rows[a:z, 2].copy().view(np.uint64), max_bits):
                        out.append((int(min(rep[i], rep[j])), int(max(rep[i], rep[j]))))
            pairs = np.array(out, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            if not len(rows):
                continue
            if held and (rows[0, :2] != held[0][0, :2]).any():
                yield links(np.concatenate(held))
                held = []
            last = int(np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))[-1]) + 1 if (
                rows[:, :2] != rows[-1, :2]).any() else 0
            if last:
                yield links(np.concatenate([*held, rows[:last]]))
                held = []
            held.append(rows[last:])
        if held:
            yield links(np.concatenate(held))

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close_links(
    reps: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT, max_cuts: int = MAX_CUTS
) -> DataFrame:
    """Links (a, b) between the ``rep`` ids of distinct fingerprints (rep, fp); their connected
    components are those of all pairs of fingerprints at most ``max_bits`` apart."""
    masks = split_mask((1 << 64) - 1, max_bits + 1)

    def cells(df: DataFrame, mask_array) -> DataFrame:
        return df.select("rep", "fp", F.explode(mask_array).alias("mask")).withColumn(
            "part", F.col("fp").bitwiseAND(F.col("mask"))
        )

    todo = cells(reps, F.array(*(F.lit(_signed(m)).cast("long") for m in masks)))
    found: DataFrame | None = None
    for cut in range(max_cuts + 1):
        hot = None
        if cut < max_cuts:
            hot = checkpointed(
                todo.groupBy("mask", "part").count().where(F.col("count") > cell_limit).select("mask", "part")
            )
            hot = hot if hot.limit(1).count() else None
        now = todo if hot is None else todo.join(hot, ["mask", "part"], "left_anti")
        rows = now.select("mask", "part", "fp", "rep").repartition("mask", "part").sortWithinPartitions("mask", "part")
        links = rows.mapInArrow(tidy(_cell_links(max_bits)), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if hot is None:
            break
        finer = {m: [m | p for p in split_mask(((1 << 64) - 1) & ~m, max_bits + 1)] for m in masks}
        deal = F.create_map(
            *(x for m, subs in finer.items() for x in (
                F.lit(_signed(m)).cast("long"), F.array(*(F.lit(_signed(s)).cast("long") for s in subs))))
        )
        todo = cells(todo.join(hot, ["mask", "part"], "left_semi"), deal[F.col("mask")])
        masks = [s for subs in finer.values() for s in subs]
    return found


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node reachable.

    Alternating large-star and small-star rounds, each a few grouped minima and joins on link
    rows; the links of a round are written to the shared checkpoint folder."""
    small, large = F.least("a", "b"), F.greatest("a", "b")
    edges = links.where(F.col("a") != F.col("b")).select(large.alias("a"), small.alias("b")).distinct()
    edges, seen = checkpointed(edges), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        star = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        moved = star.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text)."""
    marked = checkpointed(fingerprints(docs, size))
    reps = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    links = close_links(reps.where("rep IS NOT NULL"), max_bits, cell_limit)
    # A document with several rows may have several fingerprints: its id links their representatives.
    named = marked.where("doc_id IS NOT NULL").distinct().join(reps, "fp")
    least = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    same_id = named.join(least.select("doc_id", "a"), "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))
    found = components(links.unionByName(same_id))
    named = reps.join(found, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
