"""Spelling variants by permuterm rotations.

1. Words: counted per task first (a bounded table), then over all tasks.
2. Rotations: a word marked with a terminator is rotated to every place. If the character after a
   place is edited, it is turned to the end, and what lies before it is a prefix: two words that
   differ by a replaced character there share that prefix, and a word that lacks the character is
   the whole prefix itself. So every word of n characters gives n prefixes that skip a character
   and n + 1 whole rotations.
3. The rotations are dealt out by prefix and sorted; words with the same prefix are a run. A run
   has at most one word for each character of the alphabet and the one word that lacks it, so no
   run is long, however frequent its words are. One scan keeps the two best of each run and gives
   each of its words the number of its neighbours and the best one; no pairs are made. A prefix
   that skips a character equal to the one before it counts for replacements only, so that a word
   which lacks one of several equal characters is met once.
4. The best neighbour over all prefixes is a word's form if it is ``RATIO`` times as frequent.
   Forms are followed to the last by pointer doubling: counts grow by ``RATIO`` at every step, so
   the depth is a logarithm of the largest count.

Defined results: null, blank and letterless texts have no words; rows that repeat a doc_id are
counted each; without a doc_id the number in a run's hash is left out (``:<run>``); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import checkpointed, tidy

MIN_CHARS = 6
MIN_COUNT = 5
#: How many times as frequent as a word its form is.
RATIO = 5
#: Runs whose hash this divides lose a code point.
DROP = 199
#: Distinct words that a task counts before it passes them on.
MEMORY = 200_000

#: Longer words send digests of their rotations.
LONG_CHARS = 64

#: Marks the end of a word in its rotations; sorts before all letters.
_END = "\x00"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(doc_id: int | None, text: str | None, drop: int = DROP) -> Counter:
    """The words of a text and how often it has them, after the deletions."""
    data = (text or "").encode().translate(_LOWER).decode()
    runs, out = Counter(_RUN.findall(data)), Counter()
    start = zlib.crc32(("" if doc_id is None else str(doc_id)).encode() + b":")
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % drop == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        if run:
            out[run] += n
    return out


def counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least so many code points and occurrences in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
            )
            total.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for word, n in words_of(doc_id.as_py(), text.as_py()).items():
                    if len(word) >= min_chars:
                        total[word] += n
                if len(total) >= MEMORY:  # but for the words of one text, the bound of the table
                    yield out()
        if total:
            yield out()

    some = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _rotated(words: DataFrame, *columns: str) -> DataFrame:
    """(prefix, skips, fresh, columns): a row for each place and each way to read its rotation."""
    placed = words.select("word", *columns, F.posexplode(F.sequence(F.lit(0), F.length("word"))).alias("_at", "_"))
    before, after = F.expr("substring(word, 1, _at)"), F.expr("substring(word, _at + 1)")
    skipped = F.struct(
        F.concat(F.expr("substring(word, _at + 2)"), F.lit(_END), before).alias("prefix"),
        F.lit(True).alias("skips"),
        F.expr("_at = 0 OR substring(word, _at, 1) <> substring(word, _at + 1, 1)").alias("fresh"),
    )
    whole = F.struct(F.concat(after, F.lit(_END), before).alias("prefix"), F.lit(False).alias("skips"), F.lit(False).alias("fresh"))
    both = F.when(F.expr("_at < length(word)"), F.array(skipped, whole)).otherwise(F.array(whole))
    return placed.select("*", F.explode(both).alias("r")).select("r.*", *columns)


def rotations(words: DataFrame, long_chars: int = LONG_CHARS) -> DataFrame:
    """(prefix, skips, fresh, n, word): each word under its prefixes that skip a character
    (``fresh``: it differs from the one before it) and under its whole rotations.

    A long word, whose rotations together are the square of its length, sends digests of itself
    and its prefixes first, and itself only to prefixes that another word has."""
    short = words.where(F.length("word") <= long_chars).withColumn("_word", F.col("word"))
    # Words share prefixes of one length, so that is what tells the two ways apart.
    rows = _rotated(short, "n", "_word").where(F.length("prefix") <= long_chars).withColumnRenamed("_word", "word")
    keyed = words.where(F.length("word") >= long_chars).withColumn("key", F.sha2("word", 256))
    digests = _rotated(keyed, "key").where(F.length("prefix") > long_chars).withColumn("prefix", F.sha2("prefix", 256))
    met = digests.groupBy("prefix").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("prefix")
    far = digests.join(met, "prefix").join(keyed, "key").select("prefix", "skips", "fresh", "n", "word")
    return rows.unionByName(far)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, n_near, near, near_n) of every word of a run of two or more, sorted rows in."""
    out: list[tuple] = []
    run: list[tuple] = []  # (skips, fresh, n, word) of the prefix at hand

    def close() -> None:
        # Best first: largest count, then least word (code points compare as UTF-8 bytes do).
        skipping = sorted((-n, w) for skips, _, n, w in run if skips)
        whole = [(-n, w) for skips, _, n, w in run if not skips]
        fresh = {w for skips, new, _, w in run if skips and new}
        for n, word in skipping:
            best = skipping[0] if skipping[0][1] != word else skipping[1] if len(skipping) > 1 else None
            near = len(skipping) - 1
            if whole and word in fresh:
                near += 1
                best = min(best, whole[0]) if best else whole[0]
            if best:
                out.append((word, -n, near, best[1], -best[0]))
        for n, word in whole:
            best = next((x for x in skipping if x[1] in fresh), None)
            if best:
                out.append((word, -n, len(fresh), best[1], -best[0]))
        run.clear()

    def made() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["word", "n", "n_near", "near", "near_n"])

    last = None
    for batch in batches:
        for prefix, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if prefix != last:
                if len(run) > 1:
                    close()
                run.clear()
                last = prefix
            run.append(tuple(row))
        if len(out) >= 5000:
            yield made()
    if len(run) > 1:
        close()
    if out:
        yield made()


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n) of every word: how many words differ from it by one inserted,
    deleted or replaced code point, and the most frequent of them (ties: the least)."""
    sorted_rows = rotations(words).repartition("prefix").sortWithinPartitions("prefix").select("prefix", "skips", "fresh", "n", "word")
    found = sorted_rows.mapInArrow(tidy(_scan), "word string, n long, n_near long, near string, near_n long")
    lone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))))
    return (
        found.unionByName(lone)
        .groupBy("word", "n")
        .agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
        .select("word", "n", "n_near", F.col("_best.w").alias("near"), (-F.col("_best.m")).alias("near_n"))
    )


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the texts."""
    words = checkpointed(counts(docs, min_chars, min_count))
    is_form = F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False))
    found = checkpointed(
        neighbours(words).select(
            "word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")
        )
    )
    # Pointers of the words that have a form; each round doubles how far they reach.
    most = words.agg(F.max("n")).first()[0] or 1
    depth = max(1, int(math.log(max(most, ratio), ratio)))
    links = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(depth.bit_length()):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return found.join(links, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
