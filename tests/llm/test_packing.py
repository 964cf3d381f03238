"""Packing against the tokenizer on whole texts and a plain check of the sequences."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logengine.llm import packing

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(packing.VOCABULARY)
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
with open(PATH, encoding="utf-8") as f:
    ENCODER = packing.Encoder(f.read())


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


ODD = [" ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "　", "'", "'s", "'ll", "’", "a", "B", "é", "ß", "×", "÷", "я", "漢",
       "字", "á", "ʰ", "ǅ", "1", "²", "٣", "…", ".", ",", "-", "🙂", "<|endoftext|>", "don't", "x'y", "ab", " the", "​", "﻿"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=12).map("".join))
def test_ids_are_those_of_the_whole_text(text):
    for _ in range(2):  # encoded, then remembered
        assert ids_of(ENCODER.encode(text)) == plain_ids(text), repr(text)


def test_memory_that_overflows():
    with open(PATH, encoding="utf-8") as f:
        small = packing.Encoder(f.read(), memory=3)
    for text in ["one two three four five", "one  two\n\nthree's", None, " ", "x" * 5000 + " y", "five four three two one"] * 2:
        assert ids_of(small.encode(text)) == plain_ids(text)


def expected_pieces(rows):
    """(doc_id, piece, start, length, crc) of every row."""
    out = Counter()
    for doc_id, text in rows:
        ids = np.array([*plain_ids(text), 2], "<u4")
        full = -(-len(ids) // 1024) - 1
        cuts = [0, *(len(ids) - 1024 * k for k in range(full, -1, -1))]
        for k, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            out[(doc_id, k, a, z - a, zlib.crc32(ids[a:z].tobytes()))] += 1
    return out


def check(rows, got, slack=1.01):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected_pieces(rows)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(r.length for r in got) // 1024)
    assert len(held) <= least * slack + 2, (len(held), least)


def test_query_matches_plain_pieces(spark):
    from logengine.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op12_sequence_packing"](spark, SF).collect()
    check(rows, found)
    again = QUERIES["op12_sequence_packing"](spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def random_histograms():
    rng = np.random.default_rng(4)
    yield rng.integers(0, 3000, 1025)
    yield np.bincount(rng.integers(1, 300, 20_000), minlength=1025)  # no exact fill by three
    yield np.bincount(np.full(1000, 700), minlength=1025)  # nothing fits beside it
    yield np.bincount([*[512] * 999, *[341] * 50, 1, 1], minlength=1025)
    yield np.bincount((1024 * rng.beta(0.5, 0.8, 50_000)).astype(int).clip(1), minlength=1025)
    yield np.bincount([1024] * 7 + [1] * 2048, minlength=1025)
    yield np.zeros(1025, int)


@pytest.mark.parametrize("histogram", list(random_histograms()))
def test_plan_uses_every_length_exactly(histogram):
    histogram = np.array(histogram)
    histogram[0] = 0
    made = packing.plan(histogram)
    used = np.zeros(1025, int)
    for lengths, n in made:
        assert sum(lengths) <= 1024 and n > 0
        for v in lengths:
            used[v] += n
    assert (used == histogram).all()
    total = sum(n for _, n in made)
    least = max(-(-int((np.arange(1025) * histogram).sum()) // 1024), int(histogram[513:].sum()))
    assert total <= 1.02 * least + 1
    slots = packing.Slots(made)
    length = np.repeat(np.arange(1025), histogram)
    number = np.concatenate([np.arange(n) for n in histogram]) if len(length) else np.empty(0, int)
    if len(length):
        sequence, offset = slots.of(length, number)
        order = np.lexsort((offset, sequence))
        s, o, v = sequence[order], offset[order], length[order]
        first = np.r_[True, np.diff(s) > 0]
        assert (o[first] == 0).all() and (o[1:] == np.where(first[1:], 0, o[:-1] + v[:-1])).all()
        assert len(np.unique(s)) == total == slots.sequences


def test_fit_comes_close_to_the_best():
    """Plain projected coordinate descent on the same least squares does not do better by much."""
    rng = np.random.default_rng(2)
    histogram = np.bincount(rng.integers(1, 25, 3000), minlength=25)
    histogram[0] = 0
    rows = packing.patterns(np.flatnonzero(histogram), 24)
    matrix = np.zeros((25, len(rows)))
    for j, r in enumerate(rows):
        for v in r[r > 0]:
            matrix[v, j] += 1
    weight = 1 / np.sqrt(np.maximum(histogram, 1.0))
    a, b = matrix * weight[:, None], histogram * weight
    x = np.zeros(len(rows))
    for _ in range(3000):
        for j in range(len(rows)):
            x[j] = max(0, x[j] + a[:, j] @ (b - a @ x) / (a[:, j] @ a[:, j]))
    best = ((a @ x - b) ** 2).sum()
    ours = packing.fitted(rows, histogram)
    assert (ours >= 0).all() and ((a @ ours - b) ** 2).sum() <= best + 1e-2 * (b**2).sum()


def test_edge_rows(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "γάμμα", "漢字"]) for _ in range(9000))
    rows = [(None, "one two"), (1, None), (1, ""), (2, long), (2, long), (3, " \n\t "), (4, "a " * 1022 + "b"), (5, "a " * 3000),
            *[(9, "same text")] * 500, *[(k, "word " * (k % 90)) for k in range(20, 400)]]
    df = spark.createDataFrame([(*r, 0, "s") for r in rows], "doc_id long, text string, length int, sequence_id string")
    packed = packing.pack(packing.checkpointed(packing.encoded(df, with_ids=True)))
    check(rows, packed.collect(), 1.05)
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == 4 * r.n_ids <= 4096 and np.frombuffer(r.ids, "<u4").max() < 50_257
    assert packing.pack(packing.checkpointed(packing.encoded(df.limit(0)))).collect() == []
