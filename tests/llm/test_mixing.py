"""Mixing: targets against repeated resharing, samples against a plain walk
through the ranking, and the odd rows."""

import hashlib
import math
import random

import pytest

from martlake.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size long, key string, q double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "k", 0.5) for i, t, s in rows], SCHEMA).repartition(3)


def resharing(sizes, weights=(5, 2, 1)):
    names = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + [k for k in sizes if k is None]
    w = {k: weights[n % 3] for n, k in enumerate(names)}
    total, target = 1.5 * sum(sizes.values()), {}
    open_ = set(names)
    while open_:
        left = total - sum(target.values())
        share = {k: left * w[k] / sum(w[x] for x in open_) for k in open_}
        over = {k for k in open_ if share[k] > 2 * sizes[k]}
        if not over:
            target.update(share)
            break
        target.update({k: 2 * sizes[k] for k in over})
        open_ -= over
    return target


def walk(rows, target):
    """taken of each row of one source, by the docstring's rules."""
    sizes = [len((t or "").split()) for _, t in rows]
    g = [len(bin(n)) - 2 for n in sizes]
    lo, hi = 0.0, 3.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2, mid * b) * n for b, n in zip(g, sizes)) < target else (lo, mid)
    copies = [min(2, hi * b) for b in g]
    out = [math.floor(c + 1e-9) for c in copies]
    rest = target - sum(w * n for w, n in zip(out, sizes))
    ranked = []
    for k, (i, t) in enumerate(rows):
        p = copies[k] - out[k]
        if sizes[k] and p > 1e-9:
            u = (int(hashlib.md5(f"42:{i}:{t or ''}".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
            ranked.append(((u / (1 - u)) * ((1 - p) / p), i, k))
    at = 0
    for _, _, k in sorted(ranked):
        if 2 * at + sizes[k] > 2 * rest + 1e-6:
            break
        out[k] += 1
        at += sizes[k]
    return {i: (w * n if n else 0) for (i, _), w, n in zip(rows, out, sizes)}


def rows_of(seed, n=600, hot=0.4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = "hot" if rng.random() < hot else rng.choice(["a", "B", "é", None, "", "z"])
        k = int(rng.paretovariate(1.1))
        out.append((i, None if rng.random() < .02 else " ".join(["w"] * min(k, 300)), s))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_walk(spark, seed):
    rows = rows_of(seed)
    got = {r["id"]: r for r in M.mix_counts(frame(spark, rows)).collect()}
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = resharing(sizes)
    for s in sizes:
        own = [(i, t) for i, t, x in rows if x == s]
        assert {got[i]["source_size"] for i, _ in own} == {sizes[s]}
        assert all(got[i]["target"] == pytest.approx(want[s]) for i, _ in own)
        plain = walk(own, got[own[0][0]]["target"])
        assert {i: got[i]["taken"] for i, _ in own} == plain
        longest = max(len((t or "").split()) for _, t in own)
        assert abs(sum(plain.values()) - want[s]) <= longest / 2 + 1e-6
        assert all(got[i]["taken"] <= 2 * len((t or "").split()) for i, t in own)


def test_mix_repeats_rows_as_often_as_counted(spark):
    rows = rows_of(3)
    df = frame(spark, rows)
    copies = {r["id"]: r["copies"] for r in M.mix_counts(df).collect()}
    mixed = M.mix(df)
    assert mixed.columns == df.columns
    seen = {}
    for r in mixed.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {i: c for i, c in copies.items() if c}


def test_odd_tables(spark):
    assert M.mix_counts(frame(spark, [(1, "a", "s")]).limit(0)).count() == 0
    empty = M.mix_counts(frame(spark, [(1, None, "s"), (2, " ", None)])).collect()
    assert {(r["id"], r["taken"], r["target"]) for r in empty} == {(1, 0, 0.0), (2, 0, 0.0)}
    same = M.mix_counts(frame(spark, [(7, "a b", "s")] * 3 + [(None, "c", None)])).collect()
    assert len({r["taken"] for r in same if r["id"] == 7}) == 1


def test_reruns_agree(spark):
    rows = rows_of(4)
    a = {r["id"]: r["taken"] for r in M.mix_counts(frame(spark, rows)).collect()}
    b = {r["id"]: r["taken"] for r in M.mix_counts(frame(spark, rows[::-1]).repartition(7)).collect()}
    assert a == b
