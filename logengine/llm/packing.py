"""Sequence packing by length patterns and non-negative least squares.

1. Every document is encoded once; its token ids end with ``END``. One longer than ``SIZE`` is cut
   into pieces of ``SIZE`` tokens, of which the first may be shorter; full pieces are sequences of
   their own. What is left to pack is the histogram of at most ``SIZE`` lengths, whatever the
   number of documents, so the plan is made on the driver from bounded data.
2. Patterns: all sets of at most ``PATTERN_PIECES`` lengths that are there and fill a sequence
   exactly. Non-negative least squares fit their repeat counts to the histogram (accelerated
   projected gradient steps on the sparse pattern matrix).
3. Repeat counts, or a share of them, are rounded. Where they ask for more pieces of a length than
   there are, a sequence goes without one.
4. The residual is packed best fit, longest first, into what such sequences have free and into new
   ones, on counts of equal sequences. Of the shares tried, the one of fewest sequences is kept:
   where few lengths fill a sequence exactly, the fit alone would use up the small pieces.
5. The plan is a list of (lengths, repeats) that uses every length exactly as often as it is there.
   Documents are numbered within their length cell by cell (:func:`common.ranked`), so that a
   length which a third of all documents have is spread over all tasks; number and plan give the
   sequence and the place in it.

Token ids: the tokenizer's for the whole text. A pre-token never goes on beyond a run of letters
(with the space before it), so texts are cut into such words and what lies between them, and a task
remembers the ids of what it has encoded; the memory is bounded and only saves time. What lies
between words stays with its neighbours where the cut would change a pre-token: apostrophes,
several white-space characters in a row before a word, letters of other scripts.

Defined results: null text is the empty text, whose only token is ``END``; strings of special
tokens in a text are ordinary text; repeated rows are packed each; an empty table gives an empty
result; other columns are ignored. Reruns give the same sequences.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import cell_counts, checkpointed, ranked, seed_bucket, seeded, tidy

VOCABULARY = "byte_bpe_50k.json"
SIZE = 1024
#: The id after each document.
END = 2
PATTERN_PIECES = 3
#: Shares of the fitted repeats that are tried; the one of fewest sequences is kept.
SHARES = (1.0, 0.75, 0.5, 0.25)
#: Gradient steps of the fit, and the share of misplaced pieces at which it ends early.
FIT_STEPS = 600
FIT_SHARE = 1e-4
SEED = 23
#: Chunks of text that a task remembers, and the longest of them.
MEMORY = 400_000
_LONG = 64

#: Latin letters, a space before them, and all that is neither.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_PARTS = re.compile(f" ?[{_LETTERS}]+|(?: (?![{_LETTERS}])|[^ {_LETTERS}])+")
_WORD = re.compile(f" ?[{_LETTERS}]+")


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is
    printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]


def _apart(part: str) -> bool:
    """The part between two words may be encoded by itself, whatever stands beside it."""
    return not (part[0].isalpha() or part[-1].isalpha() or part[-1] == "'" or part[-2:].isspace() and len(part) > 1)


class Encoder:
    """Token ids of whole texts, as bytes of little-endian 32-bit numbers."""

    def __init__(self, vocabulary: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer, self.memory = Tokenizer.from_str(vocabulary), memory
        self.tokenizer.encode_special_tokens = True
        self.merged = self.tokenizer.model.tokenize  # of one pre-token, written in byte characters
        self.characters = dict(enumerate(_byte_characters()))
        # Ids of words and of parts that may be encoded by themselves.
        self.seen: dict[str, bytes] = {}

    def _new(self, chunk: str) -> bytes:
        if _WORD.fullmatch(chunk):
            written = chunk.encode().decode("latin-1").translate(self.characters)
            return array("I", [t.id for t in self.merged(written)]).tobytes()
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _known(self, chunk: str) -> bytes:
        ids = self.seen.get(chunk)
        if ids is None:
            ids = self._new(chunk)
            if len(chunk) <= _LONG:
                if len(self.seen) >= self.memory:
                    self.seen.clear()
                self.seen[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        parts = _PARTS.findall(text or "")
        ids = list(map(self.seen.get, parts))
        for i, part in enumerate(parts) if None in ids else ():
            if ids[i] is None:
                if not (_WORD.fullmatch(part) or _apart(part)):
                    return self._beside(parts)
                ids[i] = self._known(part)
        return b"".join(ids)

    def _beside(self, parts: list[str]) -> bytes:
        """Ids of parts of which some belong with their neighbours."""
        chunks: list[list[str]] = []
        goes_on = False
        for part in parts:
            word = _WORD.fullmatch(part) is not None
            if chunks and (goes_on or not word and part[0].isalpha()):
                chunks[-1].append(part)
            else:
                chunks.append([part])
            goes_on = not word and not _apart(part)
        # Chunks that are one part are words, or parts that may stand alone or end the text.
        out = []
        for i, chunk in enumerate(chunks):
            joined = "".join(chunk)
            alone = len(chunk) > 1 or i + 1 < len(chunks) or _WORD.fullmatch(joined) or _apart(joined)
            out.append(self._known(joined) if alone else self._new(joined))
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """The worker's encoder for a vocabulary: later tasks reuse what it has encoded."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def piece_lengths(n: int, size: int = SIZE) -> list[int]:
    """Lengths of the pieces of a document of n tokens: full ones, but for the first."""
    full = -(-n // size) - 1
    return [n - full * size, *[size] * full]


def encoded(docs: DataFrame, path: str | None = None, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_ids, crcs) of every row: the tokens of its document and the crc32 of each piece's
    ids as little-endian 32-bit numbers; with the pieces' ``ids`` (binary) themselves if asked for."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                count, crcs, kept = [], [], []
                for text in part.column(1):
                    data = encoder.encode(text.as_py()) + last
                    cuts = np.cumsum([0, *piece_lengths(len(data) // 4, size)]) * 4
                    pieces = [data[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
                    count.append(len(data) // 4)
                    crcs.append([zlib.crc32(p) for p in pieces])
                    kept.append(pieces)
                columns = [part.column(0), pa.array(count, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))]
                names = ["doc_id", "n_ids", "crcs"]
                if with_ids:
                    columns, names = [*columns, pa.array(kept, pa.list_(pa.binary()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_ids long, crcs array<long>" + (", ids array<binary>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)


def patterns(lengths: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Rows of at most three lengths, falling, zero-filled, that fill a sequence exactly."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    a, b = np.meshgrid(np.arange(size + 1), np.arange(size + 1), indexing="ij")
    c = size - a - b
    a, b, c = (v[(a >= b) & (b >= c) & (c >= 0)] for v in (a, b, c))
    fits = there[a] & (there[b] | (b == 0)) & (there[c] | (c == 0))
    return np.stack([a[fits], b[fits], c[fits]], axis=1)


def fitted(rows: np.ndarray, histogram: np.ndarray, steps: int | None = None) -> np.ndarray:
    """Repeat counts (not negative) of the patterns whose lengths come closest to the histogram."""
    want = histogram.astype(float)
    want[0] = 0
    scale = np.sqrt(np.maximum(want, 1.0))  # pieces of rare lengths weigh no less than of frequent ones
    parts = [rows[:, i] for i in range(rows.shape[1])]

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(p, x, len(want)) for p in parts)
        total[0] = 0
        return total

    def back(r: np.ndarray) -> np.ndarray:
        return sum(r[p] for p in parts)

    weight = 1 / scale
    weight[0] = 0
    # The patterns' own scale: what their rarest length allows.
    unit = np.min([np.where(p > 0, want[p], np.inf) for p in parts], axis=0)
    unit = np.sqrt(np.maximum(unit, 1e-9))
    v = np.ones(len(rows))
    for _ in range(20):
        v /= np.linalg.norm(v)
        v = unit * back(weight * weight * used(unit * v))
    step = 1 / (1.05 * np.linalg.norm(v))
    x = y = np.zeros(len(rows))
    t, last = 1.0, np.inf
    for k in range(steps or FIT_STEPS):
        gap = used(unit * y) - want
        if k % 25 == 0 and np.abs(gap).sum() <= FIT_SHARE * want.sum():
            break
        new = np.maximum(0, y - step * unit * back(weight * weight * gap))
        loss = float(((weight * gap) ** 2).sum())
        if loss > last:  # momentum that overshoots starts anew
            t = 1.0
        last, again = loss, (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / again * (new - x)
        x, t = new, again
    return unit * x


def best_fit(
    histogram: np.ndarray, begun: list[tuple[tuple[int, ...], int]] | None = None, size: int = SIZE
) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that pack the lengths into the sequences begun and new ones: longest
    first, each into the fullest sequence that has room. Equal sequences are one entry, so work
    depends on lengths, not on their counts."""
    room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(size + 1)]
    for lengths, n in begun or []:
        room[size - sum(lengths)].append((lengths, n))
    for length in range(size, 0, -1):
        left = int(histogram[length])
        for free in range(length, size + 1):
            if not left:
                break
            # Taken in turn, so that a sequence with room for more is asked again as a fuller one.
            entries, room[free] = room[free], []
            while entries and left:
                lengths, n = entries.pop()
                some = min(n, left)
                if n > some:
                    entries.append((lengths, n - some))
                fit = min(some, left)
                left -= fit
                room[free - length].append(((*lengths, length), fit))
            room[free] += entries
        while left:  # new sequences, each with as many as fit in
            each = min(size // length, left)
            n = left // each
            room[size - each * length].append(((length,) * each, n))
            left -= n * each
    return [e for entries in room for e in entries]


def rounded(rows: np.ndarray, counts: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of the patterns, whole numbers of times and most frequent first, as far
    as their longest piece lasts; of the others, a sequence goes without those that are used up.
    Takes what it uses from ``left``."""
    out: list[tuple[tuple[int, ...], int]] = []
    for i in np.argsort(-counts, kind="stable").tolist():
        longest, *others = (v for v in rows[i].tolist() if v)
        repeats = min(int(counts[i] + 0.5), int(left[longest]))
        if not repeats:
            continue
        made: list[tuple[tuple[int, ...], int]] = [((longest,), repeats)]
        left[longest] -= repeats
        for v in others:
            more = []
            for lengths, n in made:
                some = min(n, int(left[v]))
                left[v] -= some
                more += [((*lengths, v), some), (lengths, n - some)]
            made = [e for e in more if e[1]]
        out += made
    return out


def plan(histogram: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): sequences that together use each length as often as the histogram says."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    rows = patterns(np.flatnonzero(left), size)
    if not len(rows):
        return best_fit(left, None, size)
    counts, found = fitted(rows, left), []
    for share in SHARES:
        rest = left.copy()
        begun = rounded(rows, share * counts, rest)
        found.append(best_fit(rest, begun, size))
    return min(found, key=lambda made: sum(n for _, n in made))


class Slots:
    """Where the r-th document of a length goes: arrays by (length, first number of a pattern)."""

    def __init__(self, made: list[tuple[tuple[int, ...], int]], size: int = SIZE):
        rows, base = [], 0
        taken = np.zeros(size + 1, np.int64)
        for lengths, n in made:
            offset = 0
            for v in sorted(set(lengths), reverse=True):
                each = lengths.count(v)
                rows.append((v, int(taken[v]), base, each, offset))
                taken[v] += n * each
                offset += each * v
            base += n
        self.sequences, self.taken = base, taken
        rows.sort()
        self.length, self.first, self.base, self.each, self.offset = np.array(rows, np.int64).reshape(-1, 5).T

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the documents with these lengths and numbers within their length."""
        # Numbers of all lengths on one axis, in the order of the rows.
        before = np.cumsum(self.taken) - self.taken
        at = np.searchsorted(before[self.length] + self.first, before[length] + number, "right") - 1
        past = number - self.first[at]
        return self.base[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


def pack(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``rows``
    (doc_id, n_ids, crcs; checkpointed), with ``ids`` if they are there."""
    first = F.expr(f"int(n_ids - (int((n_ids + {size - 1}) div {size}) - 1) * {size})")
    placed = rows.withColumn("_len", first).withColumn("_seed", seeded(SEED, F.col("doc_id"), F.col("n_ids"), F.col("crcs")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.withColumn("_cell", seed_bucket(F.col("_seed"), parts))
    cells = checkpointed(cell_counts(placed, ["_len"], "_cell"))
    histogram = np.zeros(size + 1, np.int64)
    for r in cells.groupBy("_len").agg(F.sum("_n").alias("n")).collect():  # at most ``size`` rows
        histogram[r["_len"]] = r["n"]
    slots = rows.sparkSession.sparkContext.broadcast(Slots(plan(histogram, size), size))
    total = int(histogram.sum())
    numbered = ranked(placed, cells, ["_len"], "_cell", [F.col("_seed"), F.col("doc_id"), F.col("crcs")], "_rank")
    with_ids = "ids" in rows.columns
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        for batch in batches:
            if not len(batch):
                continue
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("_len", "_rank"))
            rank -= 1
            sequence, offset = s.of(length, rank)
            crcs = batch.column("crcs")
            count = np.diff(crcs.offsets.to_numpy())
            owner = np.repeat(np.arange(len(batch)), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            lead = piece == 0
            # Full pieces: numbers after those of the plan, by the document's number among all.
            number = (np.cumsum(s.taken) - s.taken)[length] + rank
            own = s.sequences + number[owner] + total * (piece - 1)
            columns = [
                batch.column("doc_id").take(pa.array(owner)), piece,
                np.where(lead, 0, length[owner] + size * (piece - 1)), np.where(lead, length[owner], size),
                crcs.flatten(), np.where(lead, sequence[owner], own), np.where(lead, offset[owner], 0),
            ]
            arrays = [(c if isinstance(c, pa.Array) else pa.array(c)).cast(t) for c, t in zip(columns, types, strict=True)]
            if with_ids:
                arrays.append(batch.column("ids").flatten())
            yield pa.RecordBatch.from_arrays(arrays, [*names, *(["ids"] if with_ids else [])])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    wanted = ["doc_id", "crcs", "_len", "_rank", *(["ids"] if with_ids else [])]
    return numbered.select(*wanted).mapInArrow(tidy(run), schema + (", ids binary" if with_ids else ""))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, ids) of :func:`pack` with ids: the ids of each sequence in their order
    (binary), at most a sequence's tokens in a group."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("ids"))
