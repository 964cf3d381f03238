"""Quality classifier: held-out accuracy, direct scores, edge rows."""

from __future__ import annotations

import math
import zlib

import numpy as np

from logengine.llm import classifier as c

DOCS = "doc_id long, text string, score string"


def test_held_out_accuracy(spark):
    from logengine.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op10_quality_classifier"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 1000
    assert sum(p == y for _, p, y in held) / len(held) > 0.96
    # Texts of few words said over and over are label 0, whatever the words: averaged vectors of
    # words can't tell most of these, and nothing but them is an input of the score.
    for label, least in ((0, 0.83), (1, 0.97)):
        own = [p == y for _, p, y in held if y == label]
        assert sum(own) / len(own) > least
    by_text = {}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.score) == r.score


def test_scores_match_the_plain_mean(spark):
    model = np.r_[np.sin(np.arange(c.BUCKETS)), 0.25]
    texts = ["", None, "one", "a b c a b c a b c é", "w " * 70_000, "x\x0by z"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    for r in c.score(df, model).collect():
        at, counts = c.Featurizer().of(texts[r.doc_id])
        logit = (model[at] @ counts / counts.sum() if len(at) else 0) + 0.25
        assert abs(r.score - 1 / (1 + np.exp(-logit))) < 1e-9
    assert c.score(df, model).columns == ["doc_id", "score", "predicted"]
    assert c.score(df.limit(0), model).collect() == []


def test_training_data(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1][:60]
    docs = [(i, "good plain words here" if i % 2 else "%% %% $$ ## %%", "s") for i in ids] + [(None, None, "s")]
    df = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1 - ids[0] % 2), (None, 1), (ids[1], None)],
                                   "doc_id long, quality int")
    rows = c.sample(df, labels, 1000).collect()
    assert {r.doc_id for r in rows} == set(ids) - {ids[0]}
    assert c.sample(df, labels, 7).count() == 7
    first, again = c.fit(df, labels), c.fit(df, labels)
    assert (first == again).all()
    got = {r.doc_id: r.predicted for r in c.score(df, first).collect()}
    assert all(got[i] == i % 2 for i in ids)
    for empty in (labels.limit(0), labels.where("quality = 1")):
        assert np.isfinite(c.fit(df, empty)).all()
    assert c.fit(df.limit(0), labels)[-1] == 0


def test_training_matches_a_plain_loop():
    """The same steps, one feature and one dimension at a time."""
    rng = np.random.default_rng(5)
    docs = []
    for i in range(12):
        at = np.unique(rng.integers(0, c.BUCKETS, 9))
        docs.append((at, rng.integers(1, 5, len(at)).astype(float), int(i % 4 == 0)))
    got = c.train(docs, epochs=3, rate=1.5)
    order = np.random.default_rng(c.SEED)
    vectors = order.uniform(-1 / c.DIM, 1 / c.DIM, (c.BUCKETS, c.DIM)).tolist()
    layer, bias, step = [[0.0] * c.DIM, [0.0] * c.DIM], [0.0, 0.0], 0
    for _ in range(3):
        for i in order.permutation(len(docs)).tolist():
            at, counts, y = docs[i]
            now, step = 1.5 * (1 - step / 36), step + 1
            weight = [n / sum(counts) for n in counts]
            mean = [sum(w * vectors[f][d] for f, w in zip(at, weight, strict=True)) for d in range(c.DIM)]
            logit = [sum(a * b for a, b in zip(layer[k], mean, strict=True)) + bias[k] for k in (0, 1)]
            top = max(logit)
            part = [math.exp(v - top) for v in logit]
            error = [(p / sum(part) - (k == y)) * (12 / (2 * (9 if y == 0 else 3))) for k, p in enumerate(part)]
            scale = 1 / math.sqrt(sum(w * w for w in weight))
            back = [sum(layer[k][d] * error[k] for k in (0, 1)) for d in range(c.DIM)]
            for k in (0, 1):
                for d in range(c.DIM):
                    layer[k][d] -= now * error[k] * mean[d]
                bias[k] -= 0.1 * now * error[k]
            for f, w in zip(at, weight, strict=True):
                for d in range(c.DIM):
                    vectors[f][d] -= now * scale * w * back[d]
    want = [sum(v[d] * (layer[1][d] - layer[0][d]) for d in range(c.DIM)) for v in vectors]
    assert np.allclose(got, [*want, bias[1] - bias[0]], atol=1e-9)
