"""Whitening against an eigendecomposition of exact cross products, and the
rank-one updates against the library's for full matrices."""

import math
from fractions import Fraction

import numpy as np
import pytest

from martlake.llm import whitening as W


def eigen_errors(s, matrix):
    scale = max(np.abs(matrix).max(), 1e-300)
    want = np.linalg.eigvalsh(matrix)
    return (np.abs(s.values - want).max() / scale, np.abs(s.vectors.T @ s.vectors - np.eye(len(want))).max(),
            np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - matrix).max() / scale)


@pytest.mark.parametrize("kind", ["random", "repeated", "flat", "tiny", "units", "graded", "offset", "one"])
def test_updates_equal_the_sum(kind):
    rng = np.random.default_rng(5)
    size = 12
    rows = rng.normal(size=(70, size))
    if kind == "repeated":
        rows = rows[rng.integers(0, 3, 70)]
    elif kind == "flat":
        rows[:, 3:] = rows[:, :1]
    elif kind == "tiny":
        rows[::2] *= 1e-9
    elif kind == "units":
        rows = np.eye(size)[rng.integers(0, size, 70)]
    elif kind == "graded":
        rows *= 10.0 ** -np.arange(size)
    elif kind == "offset":
        rows += 1000
    elif kind == "one":
        rows = rows[:, :1]
    s = W.Spectrum(rows.shape[1])
    for r in rows:
        s.update(r)
    assert max(eigen_errors(s, rows.T @ rows)) < 1e-12
    blocks = [W.Spectrum(rows.shape[1]) for _ in range(3)]
    for b, part in zip(blocks, (rows[:40], rows[40:69], rows[69:])):
        b.add_rows(part)
    for b in blocks[1:]:
        blocks[0].combine(b.values, b.vectors)
    assert max(eigen_errors(blocks[0], rows.T @ rows)) < 1e-12


def test_roots_lie_between_the_values():
    rng = np.random.default_rng(6)
    for _ in range(200):
        k = rng.integers(1, 9)
        values = np.sort(rng.normal(size=k)) * 10.0 ** rng.integers(-6, 6)
        z = rng.normal(size=k) * 10.0 ** rng.integers(-6, 6, size=k)
        kept = W.deflate(values, z, np.eye(k))
        values, z = values[kept], z[kept]
        if not len(z):
            continue
        roots, apart = W.secular_roots(values, z)
        assert (apart[np.arange(len(z)), np.arange(len(z))] < 0).all()
        assert (apart[np.arange(1, len(z)), np.arange(len(z) - 1)] > 0).all()
        want = np.linalg.eigvalsh(np.diag(values) + np.outer(z, z))
        assert np.allclose(roots, want, rtol=1e-12, atol=1e-13 * np.abs(want).max())


def reference(vectors):
    """n, sums, exact covariance (as doubles), by fractions."""
    x = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    apart = [[c - m for c, m in zip(row, mean)] for row in fit]
    d = len(sums)
    v = np.array([[float(sum(r[i] * r[j] for r in apart) / n) for j in range(d)] for i in range(d)])
    return x, n, sums, v


def check(rows, vectors, k):
    x, n, sums, v = reference([vectors[i] for i in sorted(vectors)])
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    own = {(r[0], r["component"]): r for r in rows}
    assert len(own) == len(rows) == len(vectors) * k
    for c in range(k):
        want = np.array([[xi - s / n for xi, s in zip(row, sums)] for row in x]) @ directions[:, c] / math.sqrt(values[c])
        got = np.array([own[i, c + 1]["whitened"] for i in sorted(vectors)])
        assert np.allclose(got, want, atol=1e-6) or np.allclose(got, -want, atol=1e-6)
    for i, row in zip(sorted(vectors), x):
        for c in range(k):
            r = own[i, c + 1]
            assert (r["n"], int(r["deviation"])) == (n, sum((n * xi - s) ** 2 for xi, s in zip(row, sums)))
            assert r["explained"] == pytest.approx(values[c] / v.trace(), rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_documented_cases(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(120, 5)) @ rng.normal(size=(5, 5)) + 3
    vectors = {i: v.tolist() for i, v in enumerate(base)}
    vectors |= {200 + i: base[0].tolist() for i in range(30)}
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5),
           (904, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (905, [1e30] * 5), (906, [1.0, 2.0])]
    df = spark.createDataFrame([*vectors.items(), *odd], "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS n", "'x' AS x", "2 AS component").repartition(11)
    check(W.whiten(df, n_components=4).collect(), vectors, 4)
    repeated = spark.createDataFrame([(None, [0.0, 0.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = W.whiten(repeated).collect()
    assert sorted(((r["id"], r["component"], r["n"], int(r["deviation"]), r["explained"]) for r in rows), key=repr) == sorted(
        [(i, c, 2, 4096, e) for i in (None, None, 7) for c, e in ((1, 1.0), (2, 0.0))], key=repr)
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["identity_error"] < 1e-12 for r in rows)


def test_one_vector_has_no_variance(spark):
    df = spark.createDataFrame([(1, [5.0, 6.0]), (2, [5.0, 6.0])], "vec_id long, embedding array<double>")
    rows = W.whiten(df).collect()
    assert len(rows) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["n"] == 1 for r in rows)


def test_large_values_stay_exact(spark):
    vectors = {i: [2.0 ** 38 * s, float(i), i * i / 7] for i, s in enumerate([1, -1, 1, -1, 0.5, 0.25])}
    rows = W.whiten(spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>"), n_components=1).collect()
    check(rows, vectors, 1)


def test_empty_tables(spark):
    assert W.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0
