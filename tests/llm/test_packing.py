"""Packing: ids against the library, the plan against exhaustive search, and
sequences that are gapless, complete and nearly full."""

import itertools
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martlake.llm import packing as P
from martlake.llm.common import tokenizer_path

PATH, RANKS = tokenizer_path(P.VOCABULARY), tokenizer_path(P.RANKS)
LIB = Tokenizer.from_file(PATH)


def ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stx12.,|<>é½"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_equal_the_library(text):
    assert np.frombuffer(P.encoder(PATH, RANKS).encode(text), "<u4").tolist() == ids(text)


def test_ids_of_documents_equal_the_library():
    import duckdb
    docs = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    for (t,) in docs:
        assert np.frombuffer(P.encoder(PATH, RANKS).encode(t), "<u4").tolist() == ids(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="latin-1"), max_size=30))
def test_usual_characters_equal_the_library(text):
    assert np.frombuffer(P.encoder(PATH, RANKS).encode(text), "<u4").tolist() == ids(text)


def test_special_strings():
    for t in ["<|endoftext|>", "a <|endoftext|>b", "it's  we'll\n\n x", "\xa0a", "a\x85b", "x" * 5000]:
        assert np.frombuffer(P.encoder(PATH, RANKS).encode(t), "<u4").tolist() == ids(t)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=5), st.integers(0, 30))
def test_closest_multiset_is_optimal(counts, room):
    used = P.closest_multiset(counts, room)
    assert all(0 < n <= counts[k] for k, n in used.items())
    items = [k for k, n in counts.items() for _ in range(n)]
    best = max(s for r in range(len(items) + 1) for c in itertools.combinations(items, r)
               if (s := sum(c)) <= room)
    assert sum(k * n for k, n in used.items()) == best


def test_plan_uses_everything_and_is_bounded():
    rng = random.Random(1)
    counts = {k: rng.randint(1, 10 ** 9) for k in range(1, 2049)}
    plan = P.minimum_bin_slack(counts, 2048)
    got = {}
    for times, used in plan:
        assert sum(k * n for k, n in used.items()) <= 2048
        for k, n in used.items():
            got[k] = got.get(k, 0) + times * n
    assert got == counts
    assert len(plan) < 10_000
    total = sum(k * n for k, n in counts.items())
    assert sum(t for t, _ in plan) * 2048 < 1.01 * total


def test_documents(spark):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, " "), (None, "a b c"), (4, "same"), (4, "same"), (5, "word " * 400)]
    rows += [(10 + i, " ".join(rng.choice(["the", "of", "zebra", "é"]) for _ in range(rng.randint(0, 90))))
             for i in range(150)]
    df = spark.createDataFrame([(i, t, 9, 8) for i, t in rows],
                               "doc_id long, text string, length long, number long").repartition(3)
    got = P.pack(df, PATH, RANKS, window=64, with_ids=True, root_share=1).collect()
    want = []
    for i, t in rows:
        full = [*ids(t or ""), 1]
        want += [(i, s, full[s:s + 64], len(full)) for s in range(0, len(full), 64)]
    mine = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["length"] * 4 == len(r["ids"]) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 64
    assert len(by) <= 1.02 * sum(r["length"] for r in got) / 64 + 2


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH, RANKS).count() == 0
