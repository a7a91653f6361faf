"""Small SQL text builders for oracle strings (same exact-decimal rules as
:mod:`martlake.functions.numeric`)."""

from __future__ import annotations

from martlake.sources.tables import CUSTOMERS_SQL, PRODUCTS_SQL, SALES_SQL


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,6))"


def msum(x: str) -> str:
    """Exact money sum returned as DOUBLE."""
    return f"CAST(SUM({dec(x)}) AS DOUBLE)"


def mprod(a: str, b: str) -> str:
    return f"({dec(a)} * {dec(b)})"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


SALES = SALES_SQL
CUSTOMERS = CUSTOMERS_SQL
PRODUCTS = PRODUCTS_SQL


def quantile(src: str, col: str, p: float) -> str:
    """Scalar subquery: exact quantile of ``col`` in ``src`` with Spark's
    ``percentile`` interpolation, written out with ROW_NUMBER."""
    return f"""(SELECT CASE WHEN floor(pos) = ceil(pos) THEN a
                 ELSE (ceil(pos) - pos) * a + (pos - floor(pos)) * b END
       FROM (SELECT MAX(pos) AS pos,
                    MAX(CASE WHEN rn - 1 = floor(pos) THEN v END) AS a,
                    MAX(CASE WHEN rn - 1 = ceil(pos) THEN v END) AS b
             FROM (SELECT CAST({col} AS DOUBLE) AS v,
                          ROW_NUMBER() OVER (ORDER BY {col}) AS rn,
                          {float(p)} * (COUNT(*) OVER () - 1) AS pos
                   FROM {src} WHERE {col} IS NOT NULL) _r) _q)"""
