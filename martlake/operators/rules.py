"""Rule trees over a table (Q7): conditions nested by ``all``, ``any`` and
``not``, comparisons of two columns, uniqueness and foreign keys.

A tree says what a row must satisfy. What one row decides becomes a boolean
column; rows are then counted by these booleans and by the key columns that a
``unique`` or ``foreign_key`` asks for, so the input is read once, repeated
rows shrink to one before they are shuffled, and every later step reads that
written table. Each check across rows is one count per key and one join of the
keys that break it.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.predicates import definitely
from martlake.operators.quality import rule_from_config, rule_report
from martlake.session import written

ACROSS_ROWS = ("unique", "foreign_key")
COMPARE = {"<": operator.lt, "<=": operator.le, "=": operator.eq, "!=": operator.ne, ">=": operator.ge, ">": operator.gt}

# Keys with more counted rows than this are spread over several tasks when
# they are joined; the heaviest HOT_KEYS of them, so that the table of hot keys
# that is broadcast holds at most that many pairs of numbers. A key beyond them
# has less than a HOT_KEYS-th of the rows.
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000


def _children(tree: dict) -> list[dict]:
    if "not" in tree:
        return [tree["not"]]
    return list(tree.get("all", tree.get("any", ())))


def _is_leaf(tree: dict) -> bool:
    return "check" in tree


def spans_rows(tree: dict) -> bool:
    """Whether a check across rows occurs in ``tree``."""
    if _is_leaf(tree):
        return tree["check"] in ACROSS_ROWS
    return any(spans_rows(t) for t in _children(tree))


def _combined(tree: dict, leaf) -> Column:
    """The tree over the columns that ``leaf`` gives, never NULL if those are not."""
    parts = [leaf(t) for t in _children(tree)]
    if "not" in tree:
        return ~parts[0]
    if "all" in tree:
        return reduce(operator.and_, parts, F.lit(True))
    if "any" in tree:
        return reduce(operator.or_, parts, F.lit(False))
    raise ValueError(f"a rule needs one of check, all, any, not: {sorted(tree)}")


def row_passes(tree: dict) -> Column:
    """Whether a row satisfies a tree without checks across rows. A check on
    a NULL passes as in :func:`quality.rule_from_config`; so does a comparison
    with a NULL on either side."""
    if not _is_leaf(tree):
        return _combined(tree, row_passes)
    if tree["check"] == "compare":
        if tree["op"] not in COMPARE:
            raise ValueError(f"unknown comparison {tree['op']!r}")
        return F.coalesce(COMPARE[tree["op"]](F.col(tree["left"]), F.col(tree["right"])), F.lit(True))
    return ~definitely(rule_from_config(tree)[1])


class _Plan:
    """Columns that the rules of one report share."""

    def __init__(self):
        self.local: list[Column] = []
        self.keys: dict[str, str] = {}
        self.across: list[dict] = []

    def passes(self, tree: dict) -> Column:
        if not spans_rows(tree):
            self.local.append(row_passes(tree).alias(f"_p{len(self.local)}"))
            return F.col(f"_p{len(self.local) - 1}")
        if not _is_leaf(tree):
            return _combined(tree, self.passes)
        if not tree["columns"]:
            raise ValueError(f"{tree['check']} needs columns")
        for c in tree["columns"]:
            self.keys.setdefault(c, f"_k{len(self.keys)}")
        if tree not in self.across:
            self.across.append(tree)
        return F.col(f"_t{self.across.index(tree)}")


def _per_key(counted: DataFrame, cols: list[str]) -> DataFrame:
    return counted.groupBy(*cols).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_counted"))


def _broken_keys(per_key: DataFrame, cols: list[str], check: dict, references: dict) -> DataFrame:
    """Keys without a NULL that break the check."""
    full = per_key.where(reduce(operator.and_, [F.col(c).isNotNull() for c in cols]))
    if check["check"] == "unique":
        return full.where(F.col("_rows") > 1).select(*cols)
    parent = references[check["references"]]
    keys = check.get("keys", check["columns"])
    if len(keys) != len(cols):
        raise ValueError(f"foreign_key of {len(cols)} columns to {len(keys)}")
    known = parent.select(*[F.col(k).alias(c) for k, c in zip(keys, cols)]).distinct()
    return full.join(known, cols, "left_anti").select(*cols)


def _flagged(counted: DataFrame, cols: list[str], broken: DataFrame, per_key: DataFrame, flag: str,
             hot_rows: int) -> DataFrame:
    """``counted`` with the column ``flag``: false for rows of a broken key.
    Rows of a hot key are spread by their hash, its broken key (one row) is
    repeated for each part. A hash shared by two keys changes the placement
    of their rows alone."""
    name = "_h"
    hot = (per_key.where(F.col("_counted") > hot_rows).orderBy(F.desc("_counted")).limit(HOT_KEYS)
           .select(F.xxhash64(*cols).alias(name), F.ceil(F.col("_counted") / hot_rows).alias("_parts")).collect())
    mark = broken.withColumn("_hit", F.lit(True))
    if not hot:
        out = counted.join(mark, cols, "left")
    else:
        parts: dict[int, int] = {}
        for r in hot:
            parts[r[0]] = max(parts.get(r[0], 1), r[1])
        spread = counted.sparkSession.createDataFrame(list(parts.items()), f"{name} bigint, _parts bigint")
        own = F.coalesce("_parts", F.lit(1))

        def placed(df, part):
            with_parts = df.withColumn(name, F.xxhash64(*cols)).join(F.broadcast(spread), name, "left")
            return with_parts.withColumn("_part", part).drop(name, "_parts")
        rows = placed(counted, F.pmod(F.xxhash64(*counted.columns), own))
        out = rows.join(placed(mark, F.explode(F.sequence(F.lit(0).cast("bigint"), own - 1))), [*cols, "_part"], "left").drop("_part")
    return out.withColumn(flag, F.col("_hit").isNull()).drop("_hit")


def tree_report(df: DataFrame, rules: list[dict], references: dict[str, DataFrame] | None = None,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """(rule, failures): rows of ``df`` that do not satisfy each rule.

    A rule is a tree with a ``name``: ``{"all": [...]}``, ``{"any": [...]}``,
    ``{"not": tree}``, or a check: those of :func:`quality.rule_from_config`,
    ``compare`` (``left``, ``op``, ``right``), ``unique`` (``columns``: the
    values occur in one row) and ``foreign_key`` (``columns``, ``references``:
    a name in ``references``, ``keys``: its columns, the same names if not
    given).

    A key with a NULL passes both checks across rows, as constraints in SQL
    do. All rows of a repeated key fail ``unique``. ``all`` of nothing passes,
    ``any`` of nothing fails. An empty table has no failures; no rules give an
    empty report. Columns of ``df`` may have any names.
    """
    plan, references = _Plan(), references or {}
    passes = [(r["name"], plan.passes(r)) for r in rules]
    flat = df.select(*plan.local, *[F.col(c).alias(k) for c, k in plan.keys.items()])
    if not plan.across:
        return rule_report(flat, [(name, ~ok) for name, ok in passes])
    rows = written(flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("_n")), "rule-rows")
    for i, check in enumerate(plan.across):
        cols = [plan.keys[c] for c in check["columns"]]
        per_key = _per_key(rows, cols)
        rows = _flagged(rows, cols, _broken_keys(per_key, cols, check, references), per_key, f"_t{i}", hot_rows)
    sums = rows.agg(*[F.coalesce(F.sum(F.when(~ok, F.col("_n"))), F.lit(0)).alias(f"_r{i}") for i, (_, ok) in enumerate(passes)])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("failures")) for i, (name, _) in enumerate(passes)])
    return sums.select(F.inline(pairs))
