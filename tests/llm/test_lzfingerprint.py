"""Lempel-Ziv fingerprints against a plain parse and brute-force neighbours."""

from __future__ import annotations

import hashlib
import random

from logengine.llm import lzfingerprint as lz

SF = "/root/testdata/sf0.01"


def plain_phrases(text):
    known, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def test_parse_matches_the_plain_loop():
    rng = random.Random(7)
    texts = ["", "a", "aa", "a" * 5000, "ab" * 999, "é漢🙂" * 50]
    texts += ["".join(rng.choice("abcé ") for _ in range(rng.randint(1, 2000))) for _ in range(100)]
    for t in texts:
        known: set[str] = set()
        at, added = lz.parse(t, 0, known)
        assert set(added) == known == plain_phrases(t) and len(added) == len(known)
        assert "".join(added) + t[at:] == t
        p = lz._Parsed(1, t)
        assert p.fingerprint == lz.fingerprint(lz.least_hashes(list(plain_phrases(t))))


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (k, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(t) // 4
        e = t[: len(t) - q] + nxt[:q]
        f, fe, fn = (lz.fingerprint(lz.least_hashes(list(plain_phrases(x)))) for x in (t, e, nxt))
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), f, fe, lz.likeness(f, fe), lz.likeness(f, fn)))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark):
    from logengine.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op9_lz_fingerprint"](spark, SF).collect()), key=str)
    assert got == expected(rows)
    near = {r[0]: r[5] for r in got}
    assert sum(near.values()) / len(near) > 2 * sum(r[6] for r in got) / len(got)


def test_edge_rows(spark):
    rows = [(5, "abc" * 30), (None, "first"), (5, "abc" * 30), (5, None), (9, ""), (-3, "x" * 4000), (7, "漢字🙂é" * 9)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, fingerprint string")
    for ranges in (1, 2, 50):
        assert sorted(map(tuple, lz.with_next(df, ranges).collect()), key=str) == expected(rows)
    one = spark.createDataFrame([(1, "solo text")], "doc_id long, text string")
    assert sorted(map(tuple, lz.with_next(one).collect()), key=str) == expected([(1, "solo text")])
    assert lz.with_next(one.limit(0)).collect() == []
    assert {r.fingerprint for r in lz.fingerprints(df.where("doc_id = 9")).collect()} == {"ffff" * lz.POSITIONS}
