"""Quality rules against their SQL, a plain count, and edge rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest

from logengine.llm import quality as q
from logengine.llm.common import checkpointed
from logengine.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, kept string, n_words int"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def verdicts(df):
    measured = checkpointed(q.measure(df))
    return q.judge(measured, checkpointed(q.thresholds(q.sketches(measured))))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(ORACLE_SQL["op2_quality_rules"])
    names = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    got = QUERIES["op2_quality_rules"](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == want


def test_counts_match_the_plain_form(spark):
    rng = random.Random(6)
    parts = ["a", "b", "é#", "\n", "\n\n", "\t", " ", "  ", "x|y", "\x0b", "\x85", "Ü"]
    texts = [None, "", "\n", " \n a", "a b c a b c", "a b a b a b", "a\nb\na\n a\na"]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts.append("w1 w2 w3 " * 9000)
    df = spark.createDataFrame([(i, t, "en", "s", "x", 1) for i, t in enumerate(texts)], COLUMNS)
    for r in q.measure(df).collect():
        want = plain(texts[r.doc_id])
        assert tuple(r[c] for c in q.LONGS) == want, repr(texts[r.doc_id])
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_thresholds_follow_each_group(spark):
    """Of two sources with symbols the one that has many keeps them; in the other such a text is an outlier."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))
    text = lambda share: " ".join(word() + "#" * (rng.random() < share) for _ in range(120))
    rows = [(i, text(0.9), "en", "code", "x", 1) for i in range(600)]
    rows += [(1000 + i, text(0.1), "en", "web", "x", 1) for i in range(600)]
    rows += [(2000, text(0.9), "en", "web", "x", 1), (2001, text(0.1), "en", "code", "x", 1), (3001, text(0.1), None, None, "x", 1)]
    got = {r.doc_id: r.kept for r in verdicts(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert sum(got[r[0]] for r in rows if r[0] < 2000) >= 1170
    assert not got[2000] and not got[2001] and got[3001]


def figures_frame(spark, groups):
    """Measured rows with given figures: {(lang, source): [value, ...]}, the same value in every figure."""
    rows = [(lang, source, False, *[v] * len(q.FIGURES)) for (lang, source), values in groups.items() for v in values]
    return spark.createDataFrame(rows, "_lang string, _source string, base_failed boolean, "
                                 + ", ".join(f"_f_{f} long" for f in q.FIGURES))


def limits_of(spark, groups):
    found = q.thresholds(checkpointed(q.sketches(figures_frame(spark, groups))))
    return {(r["_lang"], r["_source"]): r.asDict() for r in found.collect()}


def test_every_limit_comes_from_the_spread(spark):
    rng = random.Random(9)
    narrow = [rng.randint(40_000, 42_000) for _ in range(2000)]
    wide = [rng.randint(20_000, 90_000) for _ in range(2000)]
    rare = [0] * 1900 + [rng.randint(1000, 3000) for _ in range(600)]
    got = limits_of(spark, {("0a", "0n"): narrow, ("0a", "0w"): wide, ("0b", "0r"): rare})
    for f in q.FIGURES:
        n, w, r = (got[k] for k in (("0a", "0n"), ("0a", "0w"), ("0b", "0r")))
        assert w[f"_low_{f}"] < n[f"_low_{f}"] < 40_000 < 42_000 < n[f"_high_{f}"] < w[f"_high_{f}"]
        assert n[f"_high_{f}"] < 60_000 and w[f"_high_{f}"] > 90_000
        # zero-inflated: zero is inside, the rest makes the upper limit
        assert r[f"_low_{f}"] == 0 and 3000 <= r[f"_high_{f}"] < 12_000


def test_no_step_with_the_size_of_a_group(spark):
    """Limits move from the language's to the group's own as documents come; 99 and 101 are much alike."""
    rng = random.Random(10)
    rest = [rng.randint(1000, 2000) for _ in range(5000)]
    high = {}
    for n in (1, 20, 99, 101, 400, 5000):
        rng = random.Random(11)
        high[n] = limits_of(spark, {("0a", "0big"): rest, ("0a", "0own"): [rng.randint(8000, 9000) for _ in range(n)]})["0a", "0own"]["_high_symbols"]
    assert abs(high[99] - high[101]) <= 0.1 * high[99]
    assert 8000 <= high[5000] <= 13_000 and high[1] < 8000


def test_limits_of_the_test_table_come_from_its_sketches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    measured = checkpointed(q.measure(docs).drop("text"))
    sketch = checkpointed(q.sketches(measured))
    wide, narrow = (checkpointed(q.thresholds(sketch, fence)) for fence in (q.FENCE, 0))
    names = [f"_high_{f}" for f in q.FIGURES]
    least = {(r["_lang"], r["_source"]): r for r in narrow.collect()}
    rows = wide.collect()
    own = sum(r[n] > least[r["_lang"], r["_source"]][n] for r in rows for n in names)
    assert own >= 0.9 * len(rows) * len(names), own  # wider than a bucket: the spread decides
    assert all(len({r[n] for r in rows}) >= 10 for n in names), [len({r[n] for r in rows}) for n in names]
    judged = q.judge(measured, wide).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    share = {r.quality: r.kept for r in judged.where("NOT base_failed").groupBy("quality").agg(
        q.F.avg(q.F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.97 and share[0] <= 0.4, share


def test_edge_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, None, None, "x", 1), (2, "", "en", "s", "x", 1), (3, good, "en", "s", "x", 1),
            (3, good, "en", "s", "x", 1), (None, good, "en", None, "x", 1), (5, "same " * 300, "en", "s", "x", 1)]
    df = spark.createDataFrame(rows, COLUMNS)
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in verdicts(df).collect()), key=str)
    assert got == sorted([(1, 0, True, False), (2, 0, True, False), (3, 60, False, True), (3, 60, False, True),
                          (None, 60, False, True), (5, 300, True, False)], key=str)
    assert verdicts(df.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, "", "en", "s", "x", 1)], COLUMNS)
    assert [r.kept for r in verdicts(nothing).collect()] == [False]


@pytest.mark.parametrize("most", [0, 100_000])
def test_a_large_threshold_table_is_joined_by_shuffle(spark, most):
    df = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60)), "en", f"s{i % 3}", "x", 1)
                                for i in range(30)], COLUMNS)
    measured = checkpointed(q.measure(df))
    limits = checkpointed(q.thresholds(q.sketches(measured)))
    assert {r.kept for r in q.judge(measured, limits, most).collect()} == {True}


def test_sketches_merge(spark):
    values = [0, 1, 127, 255, 256, 257, 1000, 123_456, (1 << 62) + 5]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", q.sketch_key(q.F.col("v")).alias("k"))
    for r in df.collect():
        assert r.k <= r.v < r.k + max(1, r.v // 127)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = checkpointed(q.measure(docs).drop("text"))
    by = ["_lang", "_source", "figure", "key"]
    halves = q.sketches(whole.where("doc_id % 2 = 0")).unionByName(q.sketches(whole.where("doc_id % 2 = 1")))
    merged = halves.groupBy(*by).agg(q.F.sum("n").alias("n"))
    assert sorted(map(str, merged.collect())) == sorted(map(str, q.sketches(whole).select(*by, "n").collect()))
