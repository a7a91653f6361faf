"""SimHash with Golay keys: the code's properties over all cases, and links
and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martlake.llm import simhash_dedup as S


def brute_fp(text, words=4):
    data = (text or "").encode()
    tok = bytes(c + 32 if 65 <= c <= 90 else c for c in data).split()
    if not tok:
        return 0
    sh = [b" ".join(tok[i:i + words]) for i in range(max(1, len(tok) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(fps, most=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_code_shares_an_index_up_to_two_errors():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300).astype(np.uint64)
    base, n = S.golay_indices(words)
    assert set(np.unique(n)) == {1, 6}
    masks = [0] + [1 << i for i in range(23)] + [1 << i | 1 << j for i in range(23) for j in range(i)]
    for m in masks:
        other, _ = S.golay_indices(words ^ np.uint64(m))
        assert (base[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all(), m


def test_keys_meet_up_to_four_errors():
    rng = random.Random(2)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        r, k = S.fuzzy_keys(np.array([x, y], np.uint64))
        assert set(k[r == 0].tolist()) & set(k[r == 1].tolist())


def test_spark_hash_is_the_same(spark):
    row = spark.createDataFrame([("an ä b c",)], "t string").select(F.xxhash64("t").alias("h")).first()
    assert row["h"] == signed(xxhash.xxh64_intdigest("an ä b c".encode(), 42))


def test_fingerprint_equals_brute_force():
    rng = random.Random(3)
    texts = ["", " \n", "One", "A b C", "a b c d", "İ É x Y z q"] + [
        " ".join(rng.choice(["Ab", "cd", "é", "X"]) for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert S.simhash(t.encode()) == brute_fp(t), t


def planted(rng, n=260):
    base = [rng.getrandbits(64) for _ in range(60)]
    out = [0, (1 << 64) - 1, 1, 3, 0b11111]
    while len(out) < n:
        x = rng.choice(base)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            x ^= 1 << b
        out.append(x)
    return out


@pytest.mark.parametrize("limits", [{}, {"max_run": 3}, {"hot_in_task": 2}, {"max_run": 3, "hot_in_task": 3}])
def test_links_connect_what_brute_force_does(spark, limits):
    fps = sorted(set(planted(random.Random(5))))
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long").repartition(3)
    pairs = S.links(df, **limits)
    got = pairs.collect()
    assert all(((r["a"] ^ r["b"]) & (2 ** 64 - 1)).bit_count() <= 4 for r in got)
    roots = {r["node"]: r["root"] for r in S.components(pairs).collect()}
    want = brute_roots(fps)
    mine = [roots.get(signed(x), signed(x)) for x in fps]
    assert len(set(mine)) == len(set(want))
    assert len(set(zip(mine, want))) == len(set(want))


def test_documents(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (None, "one"), (6, "a b"), (None, "z z z")]
    for i in range(12):
        t = [rng.choice(words) for _ in range(300)]
        for k in range(rng.randint(1, 5)):
            u = list(t)
            u[rng.randrange(300)] = "edit"
            rows.append((100 + 10 * i + k, " ".join(u if k else t)))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp long, root long")
    got = {(r["id"], r["fp"]): r["component_id"] for r in S.near_duplicates(df).collect()}
    fps = [brute_fp(t) for _, t in rows]
    roots = brute_roots(fps)
    for (i, _), fp, root in zip(rows, fps, roots):
        ids = [rows[k][0] for k, r in enumerate(roots) if r == root and rows[k][0] is not None]
        assert got[i, signed(fp)] == (min(ids) if ids else None)
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(roots))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    assert S.drop_near_duplicates(df).count() == 0


def test_one_row_of_a_component_with_repeated_and_null_ids(spark):
    rng = random.Random(7)
    words = [[f"w{rng.randrange(10 ** 6)}" for _ in range(400)] for _ in range(3)]
    near = [[" ".join(w), " ".join(w[:-1] + ["other"]), " ".join(w[:-1] + ["another"])] for w in words]
    fps = [[brute_fp(t) for t in ts] for ts in near]
    for f in fps:
        assert len(set(brute_roots(f))) == 1
    rows = ([(1, t) for t in near[0]] + [(None, t) for t in near[1]] + [(None, near[2][0]), (7, near[2][1]), (7, near[2][1])])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in S.drop_near_duplicates(df).collect()]
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - ((xxhash.xxh64_intdigest(t.encode(), 42) >> 63) << 64)
    assert sorted(kept, key=repr) == sorted([(1, min(near[0], key=signed)), (None, min(near[1], key=signed)), (7, near[2][1])], key=repr)
