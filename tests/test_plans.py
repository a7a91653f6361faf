"""Plan hygiene for every registered query: no cartesian products, no
nested-loop joins, no Python UDF evaluation, and scans read only the columns
the query needs."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from martlake.plans.registry import QUERIES, load_all

load_all()

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}\n{plan[:3000]}"


def test_lineitem_scan_is_pruned(spark):
    plan = _plan(QUERIES["sales_by_category"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s or "l_partkey" in s]
    assert lineitem and all("l_shipdate" not in s and "l_tax" not in s for s in lineitem)


def test_bucketed_line_order_join_has_no_exchange(spark, tmp_path):
    """Co-located join: lineitem and orders bucketed by order key join
    without shuffling either side; results equal the unbucketed frame."""
    from martlake.operators import sales as S
    from martlake.sources import layout as L
    from martlake.sources import tables as T
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li, od = L.bucket_sales_inputs(spark, SF_SMALL, str(tmp_path), 4, prefix="bkt")
        joined = spark.table(li).join(spark.table(od), F.col("l_orderkey") == F.col("o_orderkey"))
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        a = S.time_stats(L.sales_from_bucketed(spark, SF_SMALL, li, od)).collect()
        b = S.time_stats(T.sales(spark, SF_SMALL)).collect()
        assert a == b
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _nodes(df) -> dict:
    names = re.findall(r"^\(\d+\) (\w+)", _plan(df), re.M)
    return {n: names.count(n) for n in set(names)} | {"Subquery": _plan(df).count("Subquery:")}


def test_statistics_are_literals_of_the_final_plan(spark):
    """One scan, no shuffle and no subquery, however many statistics."""
    for name in ("outliers_iqr", "outliers_zscore", "minmax_scaled", "fill_missing_sequence", "price_to_global_stats"):
        n = _nodes(QUERIES[name](spark, SF_SMALL))
        assert n.get("Scan", 0) == 1 and not n.get("Exchange") and not n["Subquery"], (name, n)


def test_history_is_one_scan_and_one_shuffle(spark):
    n = _nodes(QUERIES["history_build"](spark, SF_SMALL))
    assert n["Scan"] == 1 and n["Exchange"] == 1 and n["Sort"] == 1, n
    n = _nodes(QUERIES["asof_lookup"](spark, SF_SMALL))
    assert n["Scan"] == 2 and n["Exchange"] <= 3, n


def test_history_of_one_key_filters_first(spark):
    plan = _plan(QUERIES["history_of_key"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: .*EqualTo\(user_id,7\)", plan), plan


def test_group_means_do_not_shuffle_the_rows(spark):
    n = _nodes(QUERIES["category_avg_price"](spark, SF_SMALL))
    assert not n.get("Exchange") and n["BroadcastExchange"] == 1, n


def test_one_plan_at_every_size(spark):
    from martlake.sources import tables as T
    plan = _plan(T.table(spark, SF_SMALL, "lineitem"))
    assert "Exchange" not in plan
