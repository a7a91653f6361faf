"""Rule trees and k-fold regression against plain loops, and what they read."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlake.operators import ml as M
from martlake.operators import rules as R

COLUMNS = ["a", "b", "_p0", "_n", "s"]
SCHEMA = "a int, b int, _p0 int, _n int, s string"


def plain_passes(tree, row, counts, parents):
    if "all" in tree:
        return all(plain_passes(t, row, counts, parents) for t in tree["all"])
    if "any" in tree:
        return any(plain_passes(t, row, counts, parents) for t in tree["any"])
    if "not" in tree:
        return not plain_passes(tree["not"], row, counts, parents)
    if tree["check"] in ("unique", "foreign_key"):
        key = tuple(row[c] for c in tree["columns"])
        if None in key:
            return True
        return counts(tree["columns"])[key] == 1 if tree["check"] == "unique" else key in parents[tree["references"]]
    if tree["check"] == "compare":
        x, y = row[tree["left"]], row[tree["right"]]
        return x is None or y is None or {"<": x < y, "<=": x <= y, "=": x == y, "!=": x != y, ">=": x >= y, ">": x > y}[tree["op"]]
    x = row[tree["column"]]
    return {"not_null": lambda: x is not None, "min": lambda: x is None or x >= tree["value"],
            "in_set": lambda: x in tree["values"]}[tree["check"]]()


def plain_report(rows, rules, parents):
    rows = [dict(zip(COLUMNS, r)) for r in rows]
    seen = {}

    def counts(columns):
        if tuple(columns) not in seen:
            out = seen[tuple(columns)] = {}
            for r in rows:
                key = tuple(r[c] for c in columns)
                out[key] = out.get(key, 0) + 1
        return seen[tuple(columns)]
    return [(r["name"], sum(not plain_passes(r, row, counts, parents) for row in rows)) for r in rules]


def random_tree(rng, depth):
    kind = rng.choice(["all", "any", "not", "leaf", "leaf"]) if depth else "leaf"
    if kind == "not":
        return {"not": random_tree(rng, depth - 1)}
    if kind != "leaf":
        return {kind: [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]}
    return rng.choice([
        {"check": "unique", "columns": rng.choice([["a"], ["a", "b"], ["_n"], ["s", "_p0"]])},
        {"check": "foreign_key", "columns": rng.choice([["a", "b"], ["b", "_n"]]), "references": "pairs", "keys": ["x", "y"]},
        {"check": "compare", "left": "a", "op": rng.choice(list(R.COMPARE)), "right": "b"},
        {"check": "not_null", "column": rng.choice(COLUMNS)},
        {"check": "min", "column": rng.choice(["a", "_n"]), "value": rng.randint(0, 9)},
        {"check": "in_set", "column": "s", "values": ["u", "v"]}])


@pytest.mark.parametrize("seed,hot_rows", [(1, 1), (2, 5), (3, 40), (4, R.HOT_ROWS)])
def test_random_trees_against_a_plain_loop(spark, seed, hot_rows):
    """Nulls, repeated rows, a key with a third of all rows, columns with the
    names used inside; every hot-key threshold gives the same report."""
    rng = random.Random(seed)

    def value(top):
        return rng.choice([None, 7, 7, *range(top)])
    rows = [(value(6), value(300), value(9), value(400), rng.choice([None, "", "u", "v", "w"])) for _ in range(300)]
    rows += rows[:40]
    pairs = [(rng.randint(0, 7), rng.randint(0, 300)) for _ in range(150)] + [(7, 7), (7, 7), (None, 1)]
    rules = [{"name": f"r{i}", **random_tree(rng, 3)} for i in range(6)] + [
        {"name": "hot", "check": "unique", "columns": ["a"]},
        {"name": "known", "check": "foreign_key", "columns": ["a", "b"], "references": "pairs", "keys": ["x", "y"]}]
    got = R.tree_report(spark.createDataFrame(rows, SCHEMA).repartition(3), rules,
                        {"pairs": spark.createDataFrame(pairs, "x bigint, y bigint")}, hot_rows)
    assert [tuple(r) for r in got.collect()] == plain_report(rows, rules, {"pairs": set(pairs)})


def test_rule_trees_of_no_rows_and_no_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rules = [{"name": "u", "check": "unique", "columns": ["a"]}, {"name": "m", "check": "min", "column": "a", "value": 1}]
    assert [tuple(r) for r in R.tree_report(empty, rules).collect()] == [("u", 0), ("m", 0)]
    assert [tuple(r) for r in R.tree_report(empty, rules[1:]).collect()] == [("m", 0)]
    assert R.tree_report(empty, []).columns == ["rule", "failures"] and R.tree_report(empty, []).count() == 0


@pytest.mark.parametrize("rule", [{"name": "x"}, {"name": "x", "check": "odd", "column": "a"},
                                  {"name": "x", "check": "unique", "columns": []},
                                  {"name": "x", "check": "compare", "left": "a", "op": "~", "right": "b"}])
def test_malformed_rules_are_refused(spark, rule):
    with pytest.raises(ValueError):
        R.tree_report(spark.createDataFrame([], SCHEMA), [rule])


def test_hot_rows_of_a_broken_key_are_spread(spark):
    """400 of 1,200 counted rows hold one repeated key, in parts of about 20."""
    counted = spark.range(1200).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("_k0"),
                                       F.col("id").alias("_k1"), F.lit(1).cast("bigint").alias("_n"))
    per_key = R._per_key(counted, ["_k0"])
    broken = R._broken_keys(per_key, ["_k0"], {"check": "unique", "columns": ["a"]}, {})
    out = R._flagged(counted, ["_k0"], broken, per_key, "_t0", 20)
    assert out.where("NOT _t0").count() == 400 and out.count() == 1200
    parts = counted.withColumn("part", F.pmod(F.xxhash64("_k0", "_k1", "_n"), F.lit(20))).where("_k0 = 0")
    assert parts.groupBy("part").count().agg(F.max("count")).first()[0] < 60
    assert "_part#" in out._jdf.queryExecution().executedPlan().toString()


def joined(spark, rows):
    return spark.createDataFrame(rows, "order_id bigint, product_id bigint, price double, quantity int, age int, segment string")


def plain_folds(rows, k):
    x = np.array([[1, r[3], r[4], r[5] == "BUILDING"] for r in rows], float)
    y = np.array([r[2] for r in rows])
    part = np.array([(r[0] + r[1]) % k for r in rows])
    out = []
    for fold in range(k):
        test = part == fold
        b = np.linalg.lstsq(x[~test], y[~test], rcond=None)[0]
        res = (y - x @ b) ** 2
        out.append((fold, int((~test).sum()), int(test.sum()), b[1], b[2], b[3], b[0],
                    1 - res[~test].sum() / ((y[~test] - y[~test].mean()) ** 2).sum(),
                    np.sqrt(res[test].mean()) if test.any() else None))
    return out


@pytest.mark.parametrize("k", [2, 5, 7])
def test_folds_against_least_squares_on_the_rows(spark, k):
    rng = random.Random(k)
    rows = [(rng.randint(-50, 10**18), rng.randint(-3, 90), round(1e6 + rng.random() * 50, 2), rng.randint(1, 50),
             rng.randint(18, 77), rng.choice(["BUILDING", "X"])) for _ in range(400)]
    rows = [r for r in rows if k < 7 or (r[0] + r[1]) % 7 != 3]
    nulls = [(1, 2, None, 3, 4, "X"), (None, 2, 1.0, 3, 4, "X"), (1, 2, 1.0, None, 4, "X")]
    got = M.regression_folds(joined(spark, rows + nulls).repartition(4), k).collect()
    for g, w in zip(got, plain_folds(rows, k), strict=True):
        assert tuple(g)[:3] == w[:3]
        for a, b in zip(tuple(g)[3:], w[3:], strict=True):
            assert (a is None and b is None) or a == pytest.approx(b, abs=2e-4)


def test_folds_without_a_solution(spark):
    same = [(i, 0, 5.0, 2, 30, "X") for i in range(10)]
    assert [tuple(r) for r in M.regression_folds(joined(spark, same), 2).collect()] == [
        (0, 5, 5, *[None] * 6), (1, 5, 5, *[None] * 6)]
    assert [tuple(r) for r in M.regression_folds(joined(spark, []), 2).collect()] == [
        (0, 0, 0, *[None] * 6), (1, 0, 0, *[None] * 6)]


def test_fold_sums_are_one_scan_and_one_shuffle_of_the_frame(spark, tmp_path):
    joined(spark, [(i, 1, 2.0, 3, 4, "X") for i in range(20)]).write.parquet(str(tmp_path / "j"))
    sums = M.fold_sums(M.ml_frame(spark.read.parquet(str(tmp_path / "j"))), ("order_id", "product_id"), 5)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
