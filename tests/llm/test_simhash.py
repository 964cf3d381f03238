"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from logengine.llm import simhash


def brute_fingerprint(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """fps: doc_id -> fingerprint; doc_id -> smallest id reachable."""
    ids, label = sorted(fps), {i: i for i in fps}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: root(i) for i in ids}


def test_fingerprint_matches_brute_force():
    for t in [None, "", " \t\n", "One", "a b c", "a b c d", "A b\x85 C\x0bd e É", "x " * 400, "q\x1cw e r t y"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t
    rng = random.Random(5)
    t = " ".join(rng.choice(["Foo", "bar", "bäz", "qux"]) for _ in range(40_000))
    assert simhash.fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("limit", [4, 100_000])
def test_planted_clusters(spark, limit):
    """Chains, dense clusters and lone fingerprints; the cell limit doesn't change the result."""
    rng = random.Random(1)
    fps, i = {}, 0
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12])):
            fps[i := i + 1] = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                base ^= 1 << b if rng.random() < 0.7 else 0
    reps = {}
    for k, f in fps.items():
        reps.setdefault(f, k)
    df = spark.createDataFrame([(k, simhash._signed(f)) for f, k in reps.items()], "rep long, fp long")
    links = simhash.close_links(df, 4, limit)
    got = {r.node: r.component for r in simhash.components(links).collect()}
    want = brute_components({k: f for f, k in reps.items()})
    assert all(got.get(k, k) == c for k, c in want.items())


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c d e"), (3, "a b c d e"), (5, "A b\tc d\ne"), (None, "a b c d e"), (7, "z y")]
    got = sorted(map(tuple, simhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    f = lambda t: f"{brute_fingerprint(t):016x}"
    want = [(1, f(""), 1), (2, f(""), 1), (3, f("a b c d e"), 3), (3, f("a b c d e"), 3), (5, f("a b c d e"), 3),
            (None, f("a b c d e"), 3), (7, f("z y"), 7)]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_id_with_the_texts_of_others(spark):
    """An id that represents no fingerprint still links those of its rows."""
    a, b, c = "a b c d e", "z y x w v u", "one two three four five six"
    rows = [(1, a), (2, b), (9, a), (9, b), (4, c), (None, b)]
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (9, 1), (9, 1), (4, 4), (None, 1)], key=str)


def test_query_matches_brute_force(spark):
    from logengine.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_simhash"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {k: brute_fingerprint(t) for k, t in texts.items()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == fps and len(got) == len(fps)
    assert {r.doc_id: r.component_id for r in got} == brute_components(fps)


def test_spanning_links_of_a_dense_cluster():
    fp = np.array([0] + [1 << b for b in range(64)] * 10, np.uint64)
    assert len(simhash.spanning_links(fp, 4)) == len(fp) - 1
