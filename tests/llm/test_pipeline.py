"""Each pipeline stage against a brute-force version of it on its own input."""

import math
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from martlake.llm import common, packing, quality_classifier
from tests.conftest import SF_SMALL
from tests.llm.test_mixing import resharing, walk
from tests.llm.test_simhash_dedup import brute_fp, brute_roots


@pytest.fixture(scope="module")
def stages(spark):
    docs = common.read_table(spark, SF_SMALL, "documents")
    odd = spark.createDataFrame(
        [(10 ** 6, None, None, None, None), (10 ** 6 + 1, "", "en", "src1", 0),
         (10 ** 6 + 2, "a  b", "en", None, 4), (10 ** 6 + 3, "a b", "en", None, 3)], docs.schema)
    docs = docs.unionByName(odd)
    out = [docs.collect()]
    for name, stage in P.STAGES:
        docs = common.written(stage(spark, docs, SF_SMALL), "test-pipeline")
        out.append(docs.collect())
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "mixing", "packing"]
    for rows in stages[:5]:
        assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    assert P.ORACLE_SQL is None


def plain_score(m, text):
    """The model on one text, passage by passage."""
    words = (text or "").encode("utf-8", "replace").split()
    hidden, gates = [], []
    for k in range(0, max(1, len(words)), quality_classifier.PASSAGE_WORDS):
        x = np.array(quality_classifier.passage_features(words[k:k + quality_classifier.PASSAGE_WORDS]), np.float32)
        h = np.tanh(((x - m["mean"]) / m["scale"]) @ m["W"] + m["c"])
        hidden.append(h)
        gates.append(sum(w * math.tanh(t) / (1 + math.exp(-u)) for w, t, u in zip(m["w"], h @ m["V"], h @ m["U"])))
    shares = [math.exp(g - max(gates)) for g in gates]
    z = sum(a * h for a, h in zip(shares, hidden)) / sum(shares)
    return 1 / (1 + math.exp(-(z @ m["v"] + m["b"])))


def test_quality(spark, stages):
    docs = spark.createDataFrame(stages[0], "doc_id long, text string, lang string, source string, n_chars long")
    model = quality_classifier.train(docs, common.read_table(spark, SF_SMALL, "labels"))
    scores = {r["doc_id"]: plain_score(model, r["text"]) for r in stages[0]}
    assert all(abs(s - quality_classifier.THRESHOLD) > 1e-9 for s in scores.values())
    assert sorted(stages[1], key=repr) == sorted(
        (r for r in stages[0] if scores[r["doc_id"]] > quality_classifier.THRESHOLD), key=repr)


def test_exact_dedup(stages):
    first = {}
    for r in sorted(stages[1], key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), r)
    assert sorted(stages[2]) == sorted(first.values())


def test_near_dedup(stages):
    rows = sorted(stages[2], key=lambda r: r["doc_id"])
    roots = brute_roots([brute_fp(r["text"]) for r in rows])
    assert sorted(stages[3]) == sorted(r for k, r in enumerate(rows) if roots[k] == k)


def test_mixing(stages):
    by = {}
    for r in stages[3]:
        by.setdefault(r["source"], []).append(r)
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in stages[3]}
    target = resharing({s: sum(size[r["doc_id"]] for r in rows) for s, rows in by.items()})
    copies = {}
    for r in stages[4]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
        assert r in by[r["source"]]
    for s, rows in by.items():
        taken = walk([(r["doc_id"], r["text"]) for r in rows], target[s])
        assert {i: w // size[i] for i, w in taken.items() if w} == {
            r["doc_id"]: copies[r["doc_id"]] for r in rows if r["doc_id"] in copies}


def test_packing(stages):
    lib = Tokenizer.from_file(common.tokenizer_path(packing.VOCABULARY))
    want = sorted((r["doc_id"], len(lib.encode(r["text"], add_special_tokens=False).ids) + 1) for r in stages[4])
    got = sorted((r["doc_id"], r["doc_tokens"]) for r in stages[5] if r["start"] == 0)
    assert got == want
    by = {}
    for r in stages[5]:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= packing.WINDOW
    assert sum(n for parts in by.values() for _, n in parts) == sum(n for _, n in want)


def test_run_and_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        common.read_table(spark, SF_SMALL, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
