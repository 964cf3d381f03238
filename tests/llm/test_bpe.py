"""BPE against tiktoken and exact round trips."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from logengine.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(P.path(bpe.RANK_FILE))


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(vocabulary.tokens)})


def test_perfect_hash_is_minimal(vocabulary):
    slots = {vocabulary.index.slot(t) for t in vocabulary.tokens}
    assert slots == set(range(len(vocabulary.tokens)))
    assert all(vocabulary.rank(t) == i for i, t in enumerate(vocabulary.tokens))
    assert vocabulary.rank(b"\xff\xfe\xfd no such token") == -1


def test_matches_the_library(vocabulary, reference):
    encoder, rng = bpe.Encoder(vocabulary, memory=50), random.Random(3)
    spaces = "".join(chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x200B, 0x2028, 0x3000))
    alphabet = "abcdefgHIJKLMN012  \n\t'sé漢字ñß🙂–́" + spaces
    texts = ["", " ", "a" * 3000, "ab" * 2000, "<|endoftext|> it's we'LL", "\x00\x1c\x85", spaces]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([c for c in (rng.randrange(0x3000),) if not 0xD800 <= c < 0xE000]))
                      for _ in range(200)) for _ in range(50)]
    for t in texts:
        ids = encoder.encode(t)
        assert ids == reference.encode_ordinary(t), repr(t)
        assert encoder.decode(ids) == t.encode()


def test_query_matches_the_library(spark, reference):
    from logengine.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op8_byte_bpe"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        ids = reference.encode_ordinary(t)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a b", 5), (2, "x " * 50_000, 5)],
                               "doc_id long, text string, ids int")
    rows = bpe.encode_documents(df).collect()
    assert [(r.doc_id, len(r.ids)) for r in rows[:2]] == [(1, 0), (1, 0)]
    assert [bytes(r.decoded) for r in rows] == [b"", b"", b"a b", b"x " * 50_000]
    assert bpe.encoding_digests(df.limit(0)).collect() == []
