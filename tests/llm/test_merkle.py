"""Merkle manifest against a plain tree per source."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logengine.llm import merkle

SF = "/root/testdata/sf0.01"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(nodes, fanout):
    """Root and, for each node, its siblings per level as (before, after)."""
    sides, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            first = k // fanout * fanout
            sides[i].append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + fanout])))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], sides


def expected(rows, fanout=16):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = own, *climb([leaf(*r) for r in own], fanout)
    if not names:
        return []
    root, tops = climb([trees[s][1] for s in names], fanout)
    out = []
    for s, top in zip(names, tops, strict=True):
        own, subroot, sides = trees[s]
        for r, side in zip(own, sides, strict=True):
            steps = side + top
            node = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1])
                node = leaf(r[0], low, *r[2:])
            for before, after in steps:
                node = h(before, node, after)
            out.append((r[0], leaf(*r), subroot, root, h(*(x for st in steps for x in st)), node, node == root))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def found(df, **kwargs):
    changed = F.when(merkle.tampered(F.col("doc_id")), merkle.document_leaf(merkle.lowered(F.col("text"))))
    leaves = df.select("*", merkle.document_leaf().alias("leaf"), changed.alias("claim"))
    return sorted(map(tuple, merkle.manifest(leaves, claim="claim", **kwargs).drop("source").collect()), key=str)


def test_query_matches_a_plain_tree(spark):
    from logengine.llm.queries import QUERIES

    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, SF).collect()), key=str)
    assert got == expected(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize("fanout, levels", [(2, 1), (3, 0), (3, 2), (4, 1), (16, 1)])
def test_exchange_at_any_shape(spark, fanout, levels):
    """Groups of every size about a power of the fanout, a hot one, partitions that are not a power."""
    rng = random.Random(fanout * 10 + levels)
    sizes = [1, 2, 3, 4, 5, 8, 9, 10, 16, 17, 26, 27, 28, 33, 300]
    rows = [(rng.randrange(-500, 500), rng.choice(["Ab", "x", None, "É Z"]), "en", f"s{i}" if i else None, j)
            for i, n in enumerate(sizes) for j in range(n)]
    rng.shuffle(rows)
    assert found(frame(spark, rows), fanout=fanout, block_levels=levels) == expected(rows, fanout)


def test_edge_rows(spark):
    rows = [(None, "A", None, None, None), (None, None, "en", "s", 3), (1, "", "", "", 0), (1, "", "", "", 0), (1, "B", "", "", 1),
            (7, "Zé漢🙂" * 9000, "de", "é", 1), (2, "x", "en", "~", -5), (10, "QQ", "en", "s", 2), (10, "QQ", "en", "s", 2)]
    df = frame(spark, rows)
    assert found(df) == expected(rows)
    clash = df.withColumn("root", F.lit("r")).withColumn("_s", F.lit(1)).withColumn("verified", F.lit("no")).withColumn("_b", F.lit(2))
    assert found(clash) == expected(rows)
    assert found(df.limit(0)) == []
    one = frame(spark, [(3, "Solo", "en", "s", 4)])
    (row,) = merkle.manifest(one.withColumn("leaf", merkle.document_leaf()), with_proof=True).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof == [] and row.proof_sha256 == h()


def test_proofs_lead_to_the_root(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).cast("string").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    for r in merkle.manifest(df, "g", "id", "d", fanout=4, block_levels=1, with_proof=True).collect():
        node = r.leaf
        for s in r.proof:
            node = h(s.before, node, s.after)
        assert node == r.root
