"""Encoding and decoding against the tokenizers library."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martlake.llm import bpe_codec as B
from martlake.llm.common import tokenizer_path

PATH = tokenizer_path(B.VOCABULARY)
LIB = Tokenizer.from_file(PATH)
OWN = B.Codec(PATH)
ANY = st.characters(exclude_categories=["Cs"])


def ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


def own_ids(texts, codec=OWN):
    return [np.frombuffer(x, "<i4").tolist() for x in codec.encode_all(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stx12.,|<>é½"), ANY), max_size=40), max_size=5))
def test_ids_equal_the_library(texts):
    assert own_ids(texts) == [ids(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e\nnt'"), max_size=60))
def test_few_letters_equal_the_library(text):
    """Overlapping and neighbouring occurrences of the same pairs."""
    fresh = B.Codec.__new__(B.Codec)
    fresh.__dict__.update(OWN.__dict__, young={}, old={}, block=8, cache_size=5)
    assert own_ids([text, text[::-1]], fresh) == [ids(text), ids(text[::-1])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50300), max_size=30))
def test_decoding_equals_the_library(some):
    assert B.decode_ids(B.pieces_of(PATH), np.array(some, np.int64)) == LIB.decode(some, skip_special_tokens=False)


def test_ids_of_documents_equal_the_library():
    import duckdb
    docs = [t for t, in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    assert own_ids(docs) == [ids(t) for t in docs]


def test_tricky_texts():
    texts = ["<|endoftext|>", "a <|endoftext|>b<|endoftext|><|endoftext|", "it's  we'll\n\n x", "\xa0a", "a\x85b", "x" * 5000,
             "ab" * 3000, " " * 5000, "\n" * 5000, "﻿ é", "😀" * 300, "\x00\x1c\x1f a", "a" * 100 + " " + "b" * 101]
    assert own_ids(texts) == [ids(t) for t in texts]
    assert [B.decode_ids(B.pieces_of(PATH), np.array(ids(t))) for t in texts] == texts


def test_parts_end_before_a_blank():
    rng = random.Random(3)
    small = B.Codec(PATH, cache_size=50, block=16)
    texts = ["".join(rng.choice(["the", " ", " ", "\n", "'s", "9", "é", "<|endoftext|>", "...", "界", "\t"])
                     for _ in range(rng.randint(0, 200))) for _ in range(60)]
    assert own_ids(texts, small) == [ids(t) for t in texts]
    assert len(small.young) <= 25 and len(small.old) <= 25


def test_vocabularies_that_are_not_plain_are_refused(tmp_path):
    with pytest.raises(ValueError):
        B.Codec(tokenizer_path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    turned = tmp_path / "turned.json"
    turned.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        B.Codec(str(turned))


def test_documents(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (5, "é界😀\x00"), (6, " " * 1_100_000), (7, "word 12\n" * 200_000),
            (8, "0123456789abcdef" * 20_000), (9, "<|endoftext|>" * 3), (10, "ab" * 100_000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, id long, ids string").repartition(3)
    encoded = B.encode(df, PATH)
    assert sorted(map(repr, encoded.collect())) == sorted(repr((i, ids(t or ""))).replace("(", "Row(id=", 1).replace(
        ", [", ", ids=[", 1) for i, t in rows)
    texts = B.decode(encoded, PATH).collect()
    assert sorted(((r["id"], r["text"]) for r in texts), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_ids_that_are_null_or_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, [99999, 64, -1]), (3, [])], "id long, ids array<int>")
    assert sorted(map(tuple, B.decode(df, PATH).collect())) == [(1, ""), (2, LIB.decode([64])), (3, "")]


def test_empty_table(spark):
    assert B.decode(B.encode(spark.createDataFrame([], "doc_id long, text string"), PATH), PATH).count() == 0
