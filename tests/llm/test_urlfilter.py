"""URL filters against brute force."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

from logengine.llm import urlfilter as u

SF = "/root/testdata/sf0.01"


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def by_list(host, path):
    best = None
    for verdict, rule in u.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


def brute_rules(labelled, min_support, min_confidence):
    """Every subset of every labelled token set, counted."""
    whole, with_verdict = Counter(), Counter()
    for tokens, verdict in labelled:
        for n in range(len(tokens) + 1):
            for sub in combinations(tokens, n):
                whole[sub] += 1
                with_verdict[sub, verdict] += 1
    need = min_support * len(labelled)
    found = {(s, v): (c / whole[s], c / len(labelled)) for (s, v), c in with_verdict.items()
             if s and c >= need and c / whole[s] >= min_confidence}
    return {(s, v): x for (s, v), x in found.items()
            if not any(found.get((tuple(t for t in s if t != d), v), (0,))[0] >= x[0] for d in s)}


def test_query_matches_brute_force(spark):
    from logengine.llm.queries import QUERIES

    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = QUERIES["op3_url_filters"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(urls)
    df = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    host, path = u.split_url(u.F.col("url"))
    tokens = {r.page_id: tuple(r.t) for r in df.select("page_id", u.tokens(u.F.col("url"), host, path).alias("t")).collect()}
    labelled = [(tokens[k], by_list(*split(x))[1]) for k, x in urls.items() if by_list(*split(x))]
    rules = brute_rules(labelled, u.MIN_SUPPORT, u.MIN_CONFIDENCE)
    assert labelled and rules
    learned = 0
    for r in got:
        host, path = split(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        mine = by_list(host, path)
        if mine:
            assert (r.rule, r.verdict) == mine
            continue
        own = set(tokens[r.page_id])
        hits = [(x[0], x[1], len(s), " ".join(s), v) for (s, v), x in rules.items() if own >= set(s)]
        assert r.rule is None
        assert (r.learned, r.verdict) == (max(hits)[3:] if hits else (None, u.DEFAULT))
        learned += bool(hits)
    assert learned


def test_edge_rows(spark):
    urls = [None, "", "no scheme/x", "HTTP://EXAMPLE.ORG/es/a", "x://org", "x://ORG/", "x://notorg/", "a://b://c/d",
            "http://a.Example.org/en/1?x=1&y", "http://a.example.org/en/2#t", "http://sub.com/fr/1", "http://com/de/",
            "http://É.com/de/x", "://", "http://?q", "http://h\n.org/p\nq", "http://x.net/" + "s/" * 5000]
    df = spark.createDataFrame([(i, x, "z") for i, x in enumerate(urls * 2)], "page_id long, url string, verdict string")
    got = u.judge(df).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path = split(urls[r.page_id % len(urls)])
        assert (r.host, r.path) == (host, path)
        assert r.rule == (by_list(host, path) or (None,))[0]
        assert r.verdict == (by_list(host, path) or (None, r.verdict))[1] and r.verdict in ("allow", "block")
    assert u.judge(df.limit(0)).collect() == []
    alone = u.judge(spark.createDataFrame([(1, "http://x.net/a")], "page_id long, url string")).collect()
    assert [(r.rule, r.verdict, r.learned) for r in alone] == [(None, "allow", None)]


def test_a_hot_url_of_many_parts(spark):
    """Most rows share one long url: at most one token of each kind, so mining stays small."""
    hot = "http://a.b.c.d.example.com/de/" + "/".join(f"s{i}" for i in range(300)) + "?" + "&".join(f"k{i}=1" for i in range(90))
    df = spark.createDataFrame([(i, hot) for i in range(400)] + [(1000 + i, f"http://x{i}.net/de/{i}") for i in range(50)],
                               "page_id long, url string")
    got = {r.page_id: r.verdict for r in u.judge(df).collect()}
    assert all(got[i] == "block" for i in range(400)) and len(got) == 450
    assert all(got[1000 + i] == "block" for i in range(50))
