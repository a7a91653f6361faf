"""Regression queries."""

from __future__ import annotations

from martlake.operators import ml as M
from martlake.plans.registry import query
from martlake.sources import tables as T

_XS = ("x1", "x2", "x3")


def _det(m) -> str:
    """Determinant of a 3 x 3 matrix of SQL expressions."""
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a}) * (({e}) * ({i}) - ({f}) * ({h})) - ({b}) * (({d}) * ({i}) - ({f}) * ({g})) + ({c}) * (({d}) * ({h}) - ({e}) * ({g})))"


def _normal_equations():
    """Sums of products, covariances of the centred columns, and the
    coefficients by Cramer's rule, as SQL text."""
    cov = {}
    for i, a in enumerate((*_XS, "y")):
        for b in (*_XS, "y")[i:]:
            cov[a, b] = cov[b, a] = f"(s_{a}{b} - s_{a} * s_{b} / n)"
    sums = ", ".join([f"SUM({a})::DOUBLE AS s_{a}" for a in (*_XS, "y")]
                     + [f"SUM({a} * {b})::DOUBLE AS s_{a}{b}" for i, a in enumerate((*_XS, "y")) for b in (*_XS, "y")[i:]])
    a = [[cov[r, c] for c in _XS] for r in _XS]
    betas = []
    for k in range(3):
        m = [[cov[r, "y"] if j == k else a[i][j] for j in range(3)] for i, r in enumerate(_XS)]
        betas.append(f"{_det(m)} / {_det(a)} AS b{k + 1}")
    return sums, cov, ", ".join(betas)


_FRAME = """SELECT CAST(p_retailprice AS DECIMAL(18,6)) AS y, CAST(l_quantity AS INTEGER) AS x1,
                  CAST(18 + c_custkey % 60 AS INTEGER) AS x2, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS x3,
                  {part}
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey"""
_COEFFICIENTS = """round(b1, 6) AS coef_quantity, round(b2, 6) AS coef_age, round(b3, 6) AS coef_premium_flag,
       round(b0, 6) AS intercept"""
_RESIDUAL = "y::DOUBLE - (b0 + b1 * x1 + b2 * x2 + b3 * x3)"
_INTERCEPT = "(s_y - b1 * s_x1 - b2 * s_x2 - b3 * s_x3) / n AS b0"


def _regression_sql() -> str:
    sums, cov, betas = _normal_equations()
    return f"""
WITH f AS ({_FRAME.format(part="(l_orderkey + l_partkey) % 10 < 8 AS train")}),
s AS (SELECT COUNT(*)::DOUBLE AS n, {sums} FROM f WHERE train),
b AS (SELECT *, {betas} FROM s),
c AS (SELECT *, {_INTERCEPT} FROM b),
e AS (SELECT SUM(CASE WHEN train THEN r * r END) AS sse, AVG(CASE WHEN NOT train THEN r * r END) AS mse
      FROM (SELECT train, {_RESIDUAL} AS r FROM f, c))
SELECT {_COEFFICIENTS}, round(1 - sse / {cov['y', 'y']}, 6) AS r2, round(sqrt(mse), 6) AS rmse FROM c, e"""


FOLDS = 5


def _folds_sql() -> str:
    """A fit of its own for each fold, and residuals row by row."""
    sums, cov, betas = _normal_equations()
    return f"""
WITH f AS ({_FRAME.format(part=f"(l_orderkey + l_partkey) % {FOLDS} AS part")}),
k AS (SELECT CAST(range AS INTEGER) AS fold FROM range({FOLDS})),
s AS (SELECT fold, COUNT(*)::DOUBLE AS n, {sums} FROM f JOIN k ON part <> fold GROUP BY fold),
b AS (SELECT *, {betas} FROM s),
c AS (SELECT *, {_INTERCEPT} FROM b),
e AS (SELECT fold, SUM(CASE WHEN part <> fold THEN r * r END) AS sse, AVG(CASE WHEN part = fold THEN r * r END) AS mse,
             COUNT(*) FILTER (WHERE part <> fold) AS n_train, COUNT(*) FILTER (WHERE part = fold) AS n_test
      FROM (SELECT fold, part, {_RESIDUAL} AS r FROM f, c) GROUP BY fold)
SELECT c.fold, n_train, n_test, {_COEFFICIENTS},
       round(1 - sse / {cov['y', 'y']}, 6) AS r2, round(sqrt(mse), 6) AS rmse FROM c JOIN e ON c.fold = e.fold"""


@query("regression_metrics", _regression_sql())
def regression_metrics(spark, d):
    """Price from quantity, customer age and a segment flag."""
    s = T.sales(spark, d)
    c = T.customers(spark, d).select("customer_id", "age", "segment")
    return M.regression_metrics(s.join(c, "customer_id"))


@query("ml_features", """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(p_retailprice AS DOUBLE) AS label,
       CAST(l_quantity AS INTEGER) AS quantity, CAST(18 + c_custkey % 60 AS INTEGER) AS age,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS premium_flag
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey""")
def ml_features(spark, d):
    """L1: the model input frame (casts, flag, NULL rows dropped)."""
    s = T.sales(spark, d)
    c = T.customers(spark, d).select("customer_id", "age", "segment")
    return M.ml_frame(s.join(c, "customer_id"))


@query("regression_folds", _folds_sql())
def regression_folds(spark, d):
    """Five folds, each held against the regression on the others."""
    s = T.sales(spark, d)
    c = T.customers(spark, d).select("customer_id", "age", "segment")
    return M.regression_folds(s.join(c, "customer_id"), FOLDS)
