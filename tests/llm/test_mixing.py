"""Mixing and sharding against brute force."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from logengine.llm import mixing, sharding

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, source string, size string"


def brute_targets(sizes: dict) -> dict:
    """sizes by source (None last) -> targets, by resharing the excess round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    got, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), [s for s in order if sizes[s]]
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            got[s] += left * weight[s] / total
        left = sum(max(0, got[s] - 2 * sizes[s]) for s in open_)
        for s in open_:
            got[s] = min(got[s], 2 * sizes[s])
        open_ = [s for s in open_ if got[s] < 2 * sizes[s]]
    return got


def test_fit_is_as_near_as_any_subset():
    rng = random.Random(2)
    for _ in range(60):
        lengths = np.array(rng.sample(range(3, 60), rng.randint(1, 4)), np.int64)
        counts = np.array([rng.randint(1, 3) for _ in lengths], np.int64)
        budget = rng.randint(0, int((lengths * counts).sum()))
        picked = mixing.fit_lengths(lengths, counts, budget)
        assert (picked >= 0).all() and (picked <= counts).all()
        sums = {sum(x * int(n) for x, n in zip(c, lengths)) for c in itertools.product(*(range(k + 1) for k in counts))}
        # The proportional part is fixed first, so only the rest is optimal; it can't be off by more than the longest.
        assert abs(int((picked * lengths).sum()) - budget) <= max(lengths)
        if len(lengths) == 1:
            assert abs(int((picked * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)
    many = np.arange(1, 3000, dtype=np.int64)
    for budget in (1, 17, 123_456, 4_000_001):
        picked = mixing.fit_lengths(many, np.full(len(many), 3), budget)
        assert int((picked * many).sum()) == budget


def test_query_matches_brute_force(spark):
    from logengine.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    source, sizes = {r.doc_id: r.source for r in docs}, defaultdict(int)
    for r in docs:
        sizes[r.source] += size[r.doc_id]
    want, got = brute_targets(sizes), QUERIES["op7_mixing"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s])
        assert r.target == pytest.approx(want[s], rel=1e-9)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    # A rest that is nearly all or nearly none of a source ends within its smallest document.
    assert all(abs(taken[s] - want[s]) <= max(1, min(v for k, v in size.items() if source[k] == s)) for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op7_mixing"](spark, SF).collect()))


def test_mixing_edge_rows(spark):
    rows = [(1, None, "a", "x"), (2, "", None, "x"), (3, "one two three", None, "x"), (3, "one two three", None, "x"),
            (None, "p q", "", "x"), (5, "w " * 30_000, "b", "x"), (6, "\n\t", "b", "x")]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    sizes = {"a": 0, None: 6, "": 2, "b": 30_000}
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    blank = mixing.mix(spark.createDataFrame([(1, None, None, "x")], DOCS)).collect()
    assert [(r.taken, r.target) for r in blank] == [(0, 0.0)]


def check_shards(rows, n):
    count = Counter(r.shard for r in rows)
    assert set(count) <= set(range(n)) and max(count.values()) - min(count[s] for s in range(n)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_query(spark):
    from logengine.llm.queries import QUERIES

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    check_shards(got, 40)
    share = Counter(d.source for d in docs.values())
    inside = Counter((r.shard, docs[r.doc_id].source) for r in got)
    for s, n in share.items():
        assert all(abs(inside[k, s] - n / 40) < 2 for k in range(40)), s
    for r in got:
        data = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    # Brute force: the same order from fractional ranks, computed in one place.
    seeds = {r.doc_id: r._seeded for r in sharding.described(
        spark.read.parquet(f"{SF}/documents.parquet")).select(
        "doc_id", sharding.seeded(sharding.SEED, sharding.F.col("doc_id"), sharding.F.col("text_crc32"))
        .alias("_seeded")).collect()}
    order = []
    for s, n in share.items():
        own = sorted((k for k, d in docs.items() if d.source == s), key=lambda k: (seeds[k], k))
        order += [((2 * i + 1) / (2 * n), f"0{s}", seeds[k], k) for i, k in enumerate(own)]
    place = {x[3]: i for i, x in enumerate(sorted(order))}
    for r in got:
        first = -(-r.shard * len(docs) // 40)
        assert place[r.doc_id] == first + r.slot and place[r.doc_id] * 40 // len(docs) == r.shard


def test_sharding_edge_rows(spark):
    rows = [(1, None, None, "x"), (None, "é", "b", "x"), (3, "t", "b", "x"), (3, "t", "b", "x"), (4, "", "", "x")]
    df = sharding.described(spark.createDataFrame(rows, DOCS))
    got = sharding.shard(df, 3).collect()
    assert len(got) == 5 and sorted(r.size for r in got) == [16, 16, 17, 17, 18]
    check_shards(got, 3)
    assert sharding.shard(df.limit(0)).collect() == []
    assert len(sharding.shard(df, 40).collect()) == 5
