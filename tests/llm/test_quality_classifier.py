"""Quality classifier: the gradient, held-out accuracy, and odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from martlake.llm import quality_classifier as Q

SCHEMA = "doc_id long, text string, lang string, source string, row string, score double"


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    bags = [rng.random((k, Q.FEATURES)) for k in (1, 3, 2)]
    y, w = np.array([1.0, 0, 1]), np.array([1.0, 2, 1])
    m = Q.fit(bags, y, w, steps=3)
    x, starts = np.concatenate(bags), np.array([0, 1, 4])

    def loss(m):
        s = Q.forward(m, x, starts)[0]
        return -(w * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / w.sum()
    g = Q.gradient(m, x, starts, y, w)
    for n in ("W", "c", "V", "U", "w", "v"):
        at = tuple(rng.integers(0, s) for s in m[n].shape)
        up, down = ({**m, n: m[n].copy()} for _ in range(2))
        up[n][at] += 1e-5
        down[n][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[n][at]) < 1e-6, n


def corpus(n=400):
    rng = random.Random(2)
    words = [f"w{'abcdefgh'[i % 8]}{'xyz' * (i % 3)}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(5, 400))]
        bad = rng.random() < .3
        if bad:  # one bad passage somewhere
            k = rng.randrange(len(t))
            t[k:k] = ["SPAM!!"] * 70
        docs.append((i, " ".join(t), "en", "s", "r", 0.1))
        labels.append((i, int(not bad), 0))
    return docs, labels


def test_learns_from_passages_and_leaves_the_fold_out(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["id"]: r for r in Q.quality_scores(d, lab).collect()}
    truth = {i: q for i, q, _ in labels}
    fold = [i for i in got if got[i]["held_out"]]
    assert len(fold) > 50
    assert np.mean([got[i]["predicted"] == truth[i] for i in fold]) > .95
    # Labels of the fold change nothing.
    flipped = lab.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["id"]: r["score"] for r in Q.quality_scores(d, flipped).collect()}
    assert all(again[i] == got[i]["score"] for i in got)


def test_passages_of_long_texts_are_spread_over_the_whole_text():
    for n in (64 * 129, 64 * 1000 + 5, 64 * 30_000):
        at = Q.passages(n, 128)
        assert len(set(at)) == 128 and at == sorted(at) and all(k % 64 == 0 and k < n for k in at)
        tenths = np.histogram(at, 10, (0, n))[0]
        assert tenths.min() >= 3 and tenths.max() <= 30, tenths
    assert list(Q.passages(0, 128)) == [0] and list(Q.passages(64 * 128, 128)) == list(Q.passages(64 * 128))
    text = " ".join(f"w{i}" for i in range(64 * 300))
    every = Q.bag(text)
    assert (Q.bag(text, 128) == every[[k // 64 for k in Q.passages(64 * 300, 128)]]).all()


def test_learns_from_long_texts_alone(spark):
    """Every labelled text is longer than any bound on bytes of the fit was."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(60):
        bad = i % 2
        words = [rng.choice(["plain", "words", "here"]) for _ in range(20_000)]
        if bad:
            words[::3] = ["SPAM!!"] * len(words[::3])
        docs.append((i, " ".join(words)))
        labels.append((i, 1 - bad))
    assert min(len(t) for _, t in docs) > 100_000
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = Q.quality_scores(d, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    truth = dict(labels)
    assert all(r["predicted"] == truth[r["id"]] for r in got)


def test_odd_rows(spark):
    docs, labels = corpus(60)
    odd = [(900, None), (901, ""), (902, " \n"), (None, "some text"), (903, "x" * 50000), (904, "w " * 30000), (0, docs[0][1])]
    d = spark.createDataFrame(docs + [(i, t, None, None, None, None) for i, t in odd], SCHEMA).repartition(2)
    lab = spark.createDataFrame(labels + [(None, 1, 0), (900, None, 0), (901, 5, 0)], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(d, lab).collect()
    assert len(got) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .3) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append(r["score"])
    assert by[900] == by[901] == by[902] and len(set(by[0])) == 1 and len(by[0]) == 2
    kept = Q.keep_good(d, lab)
    assert kept.columns == d.columns
    assert kept.count() == sum(r["predicted"] for r in got)


def test_without_labels_or_rows(spark):
    d = spark.createDataFrame(corpus(20)[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in Q.quality_scores(d, none).collect()} == {1.0}
    one = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "doc_id long, quality int")
    assert {r["score"] for r in Q.quality_scores(d, one).collect()} <= {0.0, 1.0}
    assert Q.quality_scores(d.limit(0), one).count() == 0
