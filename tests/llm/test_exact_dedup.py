"""Exact dedup against a brute-force grouping, with splits and salting."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlake.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, row string, path string, lead long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(
        [(i, t, f"r{k}", "p", 7) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(parts)


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [r[0] for r, m in zip(rows, norm) if m == n]
        known = [x for x in ids if x is not None]
        out.append((i, min(known) if known else None, len(ids)))
    return sorted(out, key=repr), len(set(norm))


def check(spark, rows, **limits):
    got = X.exact_duplicates(frame(spark, rows), **limits).collect()
    want, groups = brute(rows)
    assert sorted([(r["id"], r["keep_id"], r["group_size"]) for r in got], key=repr) == want
    assert sum(r["kept"] for r in got) == groups
    assert all(r["id"] == r["keep_id"] for r in got if r["kept"])


ROWS = [(1, "a  b"), (2, "a b"), (3, "a\tb"), (4, None), (5, ""), (6, " "), (7, "a b "), (None, "a b"),
        (9, "x" * 5000), (10, "x" * 5000), (2, "a b"), (11, "é b"), (12, "é b")]


def test_equals_brute_force(spark):
    check(spark, ROWS)


def test_splits_and_salts_when_tables_are_small(spark):
    rows = ROWS + [(100 + i, f"copy {i % 3} " + "y" * 300) for i in range(60)]
    check(spark, rows, bucket_bytes=500, table_bytes=600)


def test_empty_table(spark):
    assert X.exact_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert X.drop_exact_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_kept_rows_carry_all_columns(spark):
    rows = ROWS + [(100 + i, f"copy {i % 3} " + "y" * 300) for i in range(60)]
    docs = frame(spark, rows)
    for limits in ({}, {"bucket_bytes": 500, "table_bytes": 600}):
        kept = X.drop_exact_duplicates(docs, **limits)
        assert kept.columns == docs.columns
        got = kept.collect()
        want, groups = brute(rows)
        assert len(got) == groups
        assert {r["doc_id"] for r in got} == {w[1] for w in want}
        assert all(r["row"] == f"r{k}" or rows[k][0] == r["doc_id"] for r in got
                   for k in [int(r["row"][1:])])


def test_colliding_hashes_are_told_apart():
    t = X.ContentTable(slots=4)
    for k in range(50):
        assert t.put(1, b"c%d" % k, k) == k
    for k in range(50):
        assert t.put(1, b"c%d" % k, -1) == k


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["a", "a ", " a", "a  ", "", None, "b\n", "b "])),
                max_size=12))
def test_random_rows(spark, rows):
    if rows:
        check(spark, rows)
