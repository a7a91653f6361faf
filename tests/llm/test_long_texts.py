"""Texts of a million characters and more through every operator on texts."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from martlake.llm import (
    bpe_codec, chat_template, exact_dedup, fill_middle, fingerprints, licenses, mixing, packing, quality_classifier, secrets,
    simhash_dedup, token_counts,
)
from martlake.llm.common import tokenizer_path
from tests.conftest import SF_SMALL

TEXTS = ["a" * 1_000_000, " " * 1_200_000, "a." * 500_000, "a-" * 500_000, "word " * 250_000, "\n" * 1_000_000,
         "0123456789abcdef" * 65_000, "\U0001f600" * 300_000, "x" * 1_500_000 + " " + "y" * 10, "user=al1 token=abcdef1\n" * 20_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.fixture(scope="module")
def lib_ids():
    lib = Tokenizer.from_file(tokenizer_path(bpe_codec.VOCABULARY))
    return [lib.encode(t, add_special_tokens=False).ids for t in TEXTS]


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_fingerprints(docs):
    got = by_id(fingerprints.edited_fingerprints(docs).withColumn("edited", F.sha2("edited", 256)).drop(
        "fingerprint", "edited_fingerprint"))
    for i, t in enumerate(TEXTS):
        half, nxt = len(t) // 2, TEXTS[(i + 1) % len(TEXTS)]
        assert got[i]["n_chars"] == len(t) and got[i]["edited"] == sha(t[:len(t) - half] + nxt[:half])


def test_secrets(docs):
    got = by_id(secrets.secret_spans(docs))
    for i, t in enumerate(TEXTS):
        want = [(m.start(), m.end()) for m in re.finditer(r"[0-9a-f]{24,}", t)]
        assert [(s["start"], s["end"]) for s in got[i]["spans"] if s["kind"] == "hex"] == want
    kinds = [s["kind"] for s in got[9]["spans"]]
    assert kinds == ["ident", "assign"] * 20_000


def test_packing(docs, lib_ids):
    rows = packing.pack(docs, tokenizer_path(packing.VOCABULARY), tokenizer_path(packing.RANKS)).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, own in enumerate(lib_ids):
        ids, at = np.array([*own, 1], "<u4"), 0
        for start, n, crc in sorted(got[i]):
            assert start == at and crc == zlib.crc32(ids[at:at + n].tobytes())
            at += n
        assert at == len(ids)


def test_token_counts(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(token_counts.MODEL))
    got = by_id(token_counts.token_counts(docs, tokenizer_path(token_counts.MODEL)))
    assert [got[i]["n_tokens"] for i in range(len(TEXTS))] == [len(model.encode(t)) for t in TEXTS]


def test_licenses(docs):
    files = docs.withColumn("p", F.lit("d/f"))
    assert {r["license"] for r in licenses.scan(files, "doc_id", "p").collect()} == {None}


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))], "doc_id long, quality int")
    got = by_id(quality_classifier.quality_scores(docs, labels))
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got.values())


def test_mixing(docs):
    got = by_id(mixing.mix_counts(docs))
    assert [got[i]["size"] for i in range(len(TEXTS))] == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in TEXTS]


def test_exact_dedup(docs):
    got = by_id(exact_dedup.exact_duplicates(docs))
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in TEXTS]
    for i, t in enumerate(normal):
        assert (got[i]["sha"], got[i]["keep_id"], got[i]["group_size"]) == (sha(t), normal.index(t), normal.count(t))


def test_chat(spark):
    turns = spark.createDataFrame([(1, 2 * i + j, r, t) for i, t in enumerate(TEXTS[:6]) for j, r in enumerate(("user", "assistant"))],
                                  "conv_id long, turn long, role string, text string")
    r = chat_template.formatted_digests(turns).first()
    assert r["loss_sha256"] == sha("".join(TEXTS[:6]))
    assert r["turns_sha256"] == sha("".join(f"user\n{t}\nassistant\n{t}\n" for t in TEXTS[:6]))


def plain_simhash(text):
    tokens = text.encode().lower().split()
    shingles = [b" ".join(tokens[i:i + 4]) for i in range(max(len(tokens) - 3, min(1, len(tokens))))]
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], "<u8")
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def test_simhash(docs):
    got = by_id(simhash_dedup.near_duplicates(docs))
    assert [got[i]["fp"] % (1 << 64) for i in range(len(TEXTS))] == [plain_simhash(t) for t in TEXTS]


def test_simhash_blocks(monkeypatch):
    texts = ["", " ", "one", "a b c d", "a b c d e f g", "A word " * 30, "  x\ny\tz  w v "]
    whole = [plain_simhash(t) for t in texts]
    for size in (1, 3, 10):
        monkeypatch.setattr(simhash_dedup, "_BLOCK", size)
        assert [simhash_dedup.simhash(t.encode()) for t in texts] == whole


def test_codec(docs, lib_ids):
    encoded = bpe_codec.encode(docs, tokenizer_path(bpe_codec.VOCABULARY))
    got = by_id(encoded)
    assert all(got[i]["ids"] == ids for i, ids in enumerate(lib_ids))
    texts = by_id(bpe_codec.decode(encoded, tokenizer_path(bpe_codec.VOCABULARY)))
    assert all(texts[i]["text"] == t for i, t in enumerate(TEXTS))


def test_fill_middle(docs):
    got = by_id(fill_middle.restored_texts(fill_middle.fill_in_middle(docs)))
    assert all(got[i]["restored"] == t for i, t in enumerate(TEXTS))


def test_pipeline(spark, docs, lib_ids):
    rows = docs
    for name, stage in corpus_pipeline.STAGES[1:4]:
        rows = stage(spark, rows, SF_SMALL)
    kept = [r["doc_id"] for r in rows.select("doc_id").collect()]
    pieces = corpus_pipeline.packing_stage(spark, rows, SF_SMALL).collect()
    assert kept and sum(r["length"] for r in pieces) == sum(len(lib_ids[i]) + 1 for i in kept)
