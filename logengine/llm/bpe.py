"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are split by the public pattern. A pre-token that is itself in the vocabulary is resolved
by a minimal perfect hash (hash and displace: one displacement per bucket of keys, every key its
own slot, no empty slot) and one byte comparison. Any other pre-token is merged: its bytes form a
linked list, and a heap of adjacent pairs by (rank, position) yields the next merge, so a
pre-token of n bytes costs O(n log n) however long it is.

The rank file is read once on the driver (fixed size, about 0.8 MB) and broadcast; its path is a
parameter. Each task keeps a bounded memory of pre-tokens that it has already resolved; it only
saves time.

Defined results: null text encodes as the empty text (no ids, empty bytes); repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import tidy

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Resolved pre-tokens that a task remembers.
MEMORY = 400_000
#: Longer pre-tokens are not remembered.
_LONG = 64
_KEYS_PER_BUCKET = 4


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, at the position of their rank."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: each has its own slot below their number.

    A bucket of several keys stores the seed that sends them to free slots; a bucket of one key
    stores its slot itself, as -1 - slot, and so fills what the others have left."""

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size // _KEYS_PER_BUCKET)
        self.shift = [0] * self.buckets
        self.owner = [0] * self.size  # key index at each slot
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, k in enumerate(keys):
            groups[xxhash.xxh3_64_intdigest(k) % self.buckets].append(i)
        taken = [False] * self.size
        for bucket in sorted((b for b in range(self.buckets) if len(groups[b]) > 1), key=lambda b: -len(groups[b])):
            own, seed = [keys[i] for i in groups[bucket]], 0
            while True:
                seed += 1
                slots = {xxhash.xxh64_intdigest(k, seed) % self.size for k in own}
                if len(slots) == len(own) and not any(taken[s] for s in slots):
                    break
            self.shift[bucket] = seed
            for i in groups[bucket]:
                slot = xxhash.xxh64_intdigest(keys[i], seed) % self.size
                taken[slot], self.owner[slot] = True, i
        free = (s for s in range(self.size) if not taken[s])
        for bucket in range(self.buckets):
            if len(groups[bucket]) == 1:
                slot = next(free)
                self.shift[bucket], self.owner[slot] = -1 - slot, groups[bucket][0]

    def slot(self, key: bytes) -> int:
        shift = self.shift[xxhash.xxh3_64_intdigest(key) % self.buckets]
        return -1 - shift if shift < 0 else xxhash.xxh64_intdigest(key, shift) % self.size


@dataclass
class Vocabulary:
    tokens: list[bytes]
    index: PerfectHash
    digest: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        tokens = read_ranks(path)
        return cls(tokens, PerfectHash(tokens), xxhash.xxh3_128_hexdigest(b" ".join(map(base64.b64encode, tokens))))

    def rank(self, token: bytes) -> int:
        """Rank of a token, -1 if it is not in the vocabulary."""
        rank = self.index.owner[self.index.slot(token)]
        return rank if self.tokens[rank] == token else -1


def merge(piece: bytes, rank) -> list[int]:
    """Ids of a byte string: the adjacent pair of least rank (leftmost first) is merged until no
    pair is in the vocabulary. ``rank`` gives a token's rank or None."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the linked parts, by their starts
    pair = [rank(piece[a : a + 2]) for a in range(n - 1)]  # rank of the part and its neighbour joined
    pair.append(None)
    heap = [r << 32 | a for a, r in enumerate(pair) if r is not None]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        a = top & 0xFFFFFFFF
        if pair[a] != top >> 32:
            continue  # one of the two parts has changed since
        z = after[after[a]]
        pair[after[a]], pair[a], after[a] = None, None, z
        if z < n:
            before[z] = a
            pair[a] = r = rank(piece[a : after[z]])
            if r is not None:
                heapq.heappush(heap, r << 32 | a)
        p = before[a]
        if p >= 0:
            pair[p] = r = rank(piece[p:z])
            if r is not None:
                heapq.heappush(heap, r << 32 | p)
    out, a = [], 0
    while a < n:
        out.append(rank(piece[a : after[a]]))
        a = after[a]
    return out


class Encoder:
    """Encodes texts with a :class:`Vocabulary`, split by a pattern."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = public_tokenizers.PATTERN, memory: int = MEMORY):
        self.v, self.find, self.memory = vocabulary, regex.compile(pattern).findall, memory
        self.pair_rank = {t: i for i, t in enumerate(vocabulary.tokens)}.get
        self.seen: dict[str, tuple[int, ...]] = {}

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode()
        whole = self.v.rank(data)
        ids = (whole,) if whole >= 0 else tuple(merge(data, self.pair_rank))
        if len(text) <= _LONG:
            if len(self.seen) >= self.memory:
                self.seen.clear()
            self.seen[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        get = self.seen.get
        for p in self.find(text or ""):
            out += get(p) or self.piece(p)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.tokens.__getitem__, ids))


def encode_documents(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, memory: int = MEMORY
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: the ids of the whole text and the bytes they
    decode to."""
    return _encoded(
        docs, path, pattern, "doc_id long, n_tokens long, ids array<int>, decoded binary",
        lambda ids, data: (len(ids), ids, data), memory,
    )


def encoding_digests(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, from the same ids and bytes."""

    def digest(ids: list[int], data: bytes) -> tuple[int, str, str]:
        return (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(data).hexdigest(),
        )

    return _encoded(docs, path, pattern, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


_ENCODERS: dict[tuple[str, str, int], Encoder] = {}


def _encoder(vocabulary, pattern: str, memory: int) -> Encoder:
    """The worker's encoder for a broadcast vocabulary: later tasks reuse what it has resolved."""
    key = (vocabulary.value.digest, pattern, memory)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary.value, pattern, memory)
    return _ENCODERS[key]


def _encoded(docs: DataFrame, path: str | None, pattern: str, schema: str, shape, memory: int = MEMORY) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary.load(path or public_tokenizers.path(RANK_FILE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last, ids = _encoder(vocabulary, pattern, memory), None, []
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows = []
                for text in part.column(1):
                    if not rows or text != last:  # copies of a row follow it
                        last, ids = text, encoder.encode(text.as_py())
                    rows.append(shape(ids, encoder.decode(ids)))
                columns = [part.column(0), *(pa.array(c) for c in zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(t) for c, t in zip(columns, types, strict=True)], names
                )

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    fields = _parse_datatype_string(schema).fields
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)
