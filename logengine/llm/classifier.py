"""Quality classifier on supervised subword embeddings.

A text's features are its words, their character n-grams (with word ends marked), its word
pairs and word triples, each hashed into one of ``BUCKETS`` learned vectors. The vectors of all
features are averaged, a linear layer and a softmax give the classes. Vectors and layer are trained
together by stochastic gradient descent in numpy, document by document, at a falling rate; the
classes weigh the same in the loss, however rare one of them is.

Training sees a bounded sample (``TRAIN_DOCS`` labelled rows, those of least seeded hash) and runs
in one task; every other step runs on all rows in parallel. Scoring needs only each bucket's share
of the logit (a vector of ``BUCKETS`` numbers, broadcast), because the mean is linear.

Only the text is ever an input of a score.

Defined results: null and blank texts have no features and get the score of the bias alone; equal
texts get equal scores; labels that are null, or contradict each other for one document, are not
learned from; rows that repeat a doc_id are scored each; without labels of two classes every
score is the share of label 1 (0.5 without labels); an empty table gives an empty result; other
columns are passed through by :func:`score` unless named like a result column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logengine.llm.common import checkpointed, extended, seeded

BUCKETS = 1 << 16
DIM = 8
MIN_GRAM, MAX_GRAM = 3, 4
TRAIN_DOCS = 3000
EPOCHS = 6
RATE = 2.0
SEED = 17

#: Words whose features a task remembers.
_MEMORY = 300_000
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def word_features(word: str) -> list[int]:
    """Buckets of a word and its character n-grams."""
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in range(MIN_GRAM, MAX_GRAM + 1) for i in range(len(marked) - n + 1)]
    digest = xxhash.xxh3_64_intdigest
    return [digest(g.encode()) % BUCKETS for g in [marked + " ", *grams]]


def _hashed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * _PAIR ^ right
    return (mixed ^ mixed >> np.uint64(29)) * _PAIR


def sequence_features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the neighbouring pairs and triples of words with these hashes."""
    pairs = _hashed(hashes[:-1], hashes[1:])
    both = np.r_[pairs, _hashed(pairs[:-1], hashes[2:])]
    return (both >> np.uint64(40)).astype(np.int64) % BUCKETS


class _Words(dict):
    """Word -> number; the words' hashes and two figures of each lie in arrays by number."""

    def __init__(self, figures):
        super().__init__()
        self.figures = figures
        self.hashes, self.first = np.zeros(_MEMORY, np.uint64), np.zeros(_MEMORY)
        self.second = np.zeros(_MEMORY)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number >= len(self.hashes):  # one text may hold more words than are remembered
            self.hashes, self.first, self.second = (np.r_[x, x * 0] for x in (self.hashes, self.first, self.second))
        self.hashes[number] = xxhash.xxh3_64_intdigest(word.encode())
        self.first[number], self.second[number] = self.figures(word, number)
        self[word] = number
        return number

    def numbers(self, text: str | None) -> np.ndarray:
        if len(self) >= _MEMORY:
            self.clear()
        words = (text or "").split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Featurizer:
    """(buckets, counts) of whole texts."""

    def __init__(self):
        self.own: dict[int, np.ndarray] = {}
        self.words = _Words(self._figures)

    def _figures(self, word: str, number: int) -> tuple[int, int]:
        self.own[number] = np.array(word_features(word))
        return len(self.own[number]), 0

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        numbers = self.words.numbers(text)
        if not len(numbers):
            return np.empty(0, np.int64), np.empty(0)
        once, times = np.unique(numbers, return_counts=True)
        at = np.concatenate([self.own[i] for i in once.tolist()])
        times = np.repeat(times, self.words.first[once].astype(np.int64))
        total = np.bincount(at, times.astype(float), BUCKETS)
        total += np.bincount(sequence_features(self.words.hashes[numbers]), minlength=BUCKETS)
        found = np.flatnonzero(total)
        return found, total[found]


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE) -> np.ndarray:
    """Each bucket's part of the logit of class 1, and the bias as last number.

    ``docs``: (buckets, counts, label). The order of each epoch is seeded."""
    rng = np.random.default_rng(SEED)
    ones = sum(y for *_, y in docs)
    if not docs or ones in (0, len(docs)):
        share = (ones + 0.5) / (len(docs) + 1)
        return np.r_[np.zeros(BUCKETS), np.log(share / (1 - share))]
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((2, DIM)), np.zeros(2)
    weights = len(docs) / (2 * (len(docs) - ones)), len(docs) / (2 * ones)  # the classes weigh the same
    steps, step = epochs * len(docs), 0
    # The mean of many features moves little; its own scale makes steps alike for any length.
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, counts, y = docs[i]
            now = rate * (1 - step / steps)
            step += 1
            weight = counts / max(1.0, counts.sum())
            mean = weight @ vectors[at]
            logit = layer @ mean + bias
            prob = np.exp(logit - logit.max())
            error = prob / prob.sum()
            error[y] -= 1
            error *= weights[y]
            scale = 1 / max(1e-9, np.sqrt((weight * weight).sum()))
            back = layer.T @ error
            layer -= now * np.outer(error, mean)
            bias -= 0.1 * now * error
            vectors[at] -= now * scale * weight[:, None] * back[None, :]
    return np.r_[vectors @ (layer[1] - layer[0]), bias[1] - bias[0]]


def sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, text, label) of the labelled rows of least seeded hash that may be learned from."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
        .where("label = _most").select("doc_id", "label")
    )
    # Only ids and labels are ordered; at most ``most`` rows are broadcast.
    some = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = checkpointed(some.orderBy(seeded(SEED, F.col("doc_id")), "doc_id").limit(most))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    featurizer = Featurizer()
    for batch in batches:
        for i in range(len(batch)):
            at, counts = featurizer.of(batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), pa.array([at.astype("<u4").tobytes()], pa.binary()),
                 pa.array([counts.astype("<u4").tobytes()], pa.binary()), batch.column(2).slice(i, 1)],
                ["doc_id", "at", "counts", "label"],
            )


def _trained(epochs: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = []
        for b in batches:
            for i in range(len(b)):
                at, counts = (np.frombuffer(b.column(k)[i].as_py(), "<u4") for k in (1, 2))
                docs.append((at.astype(np.int64), counts.astype(float), b.column(3)[i].as_py()))
        model = train(docs, epochs, rate)
        yield pa.RecordBatch.from_arrays([pa.array([model.astype("<f8").tobytes()], pa.binary())], ["model"])

    return run


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, epochs: int = EPOCHS, rate: float = RATE) -> np.ndarray:
    """The model learned from ``labels`` (doc_id, quality) of the rows that are not held out."""
    rows = sample(docs, labels, most).select("doc_id", "text", F.col("label").cast("int"))
    rows = rows.mapInArrow(_featured, "doc_id long, at binary, counts binary, label int")
    one = rows.repartition(1).sortWithinPartitions("doc_id")  # at most ``most`` rows
    found = one.mapInArrow(_trained(epochs, rate), "model binary").first()
    return np.frombuffer(found[0], "<f8") if found else train([])


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``docs`` without text, with ``score`` (probability of class 1) and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model))
    own = [c for c in docs.columns if c not in {"text", "score", "predicted"}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        part, bias = model[:-1], float(model[-1])

        def figures(word: str, number: int) -> tuple[float, int]:
            at = word_features(word)
            return float(part[at].sum()), len(at)

        words = _Words(figures)

        def logit(text: str | None) -> float:
            at = words.numbers(text)
            if not len(at):
                return bias
            more = sequence_features(words.hashes[at])
            return (words.first[at].sum() + part[more].sum()) / (words.second[at].sum() + len(more)) + bias

        for batch in batches:
            logits = np.array([logit(t.as_py()) for t in batch.column(0)], float)
            scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [*own, "score", "predicted"],
            )

    rows = docs.select("text", *own)
    schema = extended(T.StructType(rows.schema.fields[1:]), ("score", T.DoubleType()), ("predicted", T.IntegerType()))
    return rows.mapInArrow(run, schema)
