"""Named queries over the driver tables and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame``; the matching SQL (when the
operator is SQL-expressible) runs on views named like the driver tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from martlake.plans import (  # noqa: F401
        sales_queries, cleaning_queries, quality_queries, history_queries,
        text_queries, stream_queries, sink_queries, ml_queries,
    )
