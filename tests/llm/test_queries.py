"""The registered queries: SQL where there is one, contracts elsewhere."""

import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as E
from martlake.llm import bpe_codec, common, packing, token_counts
from martlake.llm.queries import ORACLE, QUERIES
from martlake.session import configure
from tests.conftest import SF_SMALL
from tests.llm.test_simhash_dedup import brute_fp, brute_roots
from tests.llm.test_whitening import check
from tools.check_oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    configure(spark)
    return QUERIES[name](spark, SF_SMALL).collect()


def test_registered():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in E.queries()) == 1
    assert "pipeline" in E.queries() and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, con, name):
    configure(spark)
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL, verbose=True)
    assert r["cols"] and r["rows"] == r["oracle_rows"] > 0 and r["values"] and not r["types"], r


def test_packing_query(spark, documents):
    lib = Tokenizer.from_file(common.tokenizer_path(packing.VOCABULARY))
    got = {}
    for r in rows(spark, "op3_bin_slack_packing"):
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert len(got) == len(documents)
    for i, t in documents:
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for start, n, crc, total in sorted(got[i]):
            assert (start, total, crc) == (at, len(ids), zlib.crc32(ids[at:at + n].tobytes()))
            at += n
        assert at == len(ids)


def test_token_count_query(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=common.tokenizer_path(token_counts.MODEL))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows(spark, "op4_token_counts")}
    for i, t in documents:
        n = len(model.encode(t))
        assert got[i] == (len(t.encode()), n, n > 4096)


def test_quality_query(spark, con):
    got = rows(spark, "op6_quality_mil")
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    fold = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert fold and np.mean([r["predicted"] == labels[r["doc_id"]] for r in fold]) > .9


def test_chat_query(spark, con):
    turns = con.execute("SELECT conv_id, turn, role, coalesce(text, '') FROM conversations").fetchall()
    tricky = r"\### Assistant: </turn> ok"
    turns += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    want = {}
    for c, _, role, text in sorted(turns):
        want.setdefault(c, []).append((role, text))
    got = {r["conv_id"]: r for r in rows(spark, "op9_chat_template")}
    assert set(got) == set(want)
    for c, own in want.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] >= sum(len(r) + len(t) for r, t in own)


def test_simhash_query(spark, documents):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op10_simhash_golay")}
    fps = [brute_fp(t) for _, t in documents]
    roots = brute_roots(fps)
    for k, (i, _) in enumerate(documents):
        assert got[i] == (f"{fps[k]:016x}", documents[roots[k]][0])


def test_codec_query(spark, documents):
    lib = Tokenizer.from_file(common.tokenizer_path(bpe_codec.VOCABULARY))
    got = {r["doc_id"]: tuple(r)[1:] for r in rows(spark, "op11_bpe_codec")}
    assert len(got) == len(documents)
    for i, t in documents:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_whitening_query(spark, con):
    vectors = dict(con.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    check(rows(spark, "op13_embedding_whitening"), vectors, 16)
