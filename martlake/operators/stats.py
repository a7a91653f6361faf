"""Exact distributed statistics with bounded per-task memory.

Spark's ``percentile`` and ``mode`` keep every distinct value of a group in
one aggregation buffer. Here a quantile is found in two reads of its column,
for all requested columns and positions at once:

1. mergeable sketches (``percentile_approx``) give a bracket of values around
   each requested rank;
2. the values inside the brackets are counted, with the number of values
   below; each bracket holds about ``2 / ACCURACY`` of the rows.

The bracket is checked against the exact counts; one that misses its rank is
widened, one that holds more than ``MAX_BRACKET`` distinct values is narrowed
by another sketch inside it, as long as that at least halves it. So results are exact, no task ever holds a whole
column, and the work follows the data at every size.

Interpolation is that of Spark's ``percentile``: with ``pos = p * (n - 1)``,
``lo = floor(pos)``, ``hi = ceil(pos)``: ``(hi - pos) * x[lo] + (pos - lo) *
x[hi]``, or ``x[lo]`` when ``lo == hi``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.numeric import col_of
from martlake.session import written

ACCURACY = 2000
MAX_BRACKET = 5_000_000


class _Bracket:
    """What is known of one requested rank: its value lies in [lo, hi]
    (None: unbounded)."""

    def __init__(self, p: float):
        self.p, self.lo, self.hi = p, None, None
        self.margin = 2.0 / ACCURACY
        self.good, self.last = None, False  # (lo, hi, distinct) before narrowing

    def inside(self, x: Column) -> Column:
        cond = x.isNotNull()
        if self.lo is not None:
            cond = cond & (x >= F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (x <= F.lit(self.hi))
        return cond


def _sketch(df: DataFrame, columns: dict, todo: dict) -> None:
    """Set the brackets of ``todo`` ({name: (column, bracket, inside, share)})
    from one sketch each, taken over the values inside the present bracket;
    ``share`` is the rank's position among those."""
    aggs = []
    for name, (c, b, inside, share) in todo.items():
        x = columns[c] if inside is None else F.when(inside, columns[c])
        lo, hi = max(0.0, share - b.margin), min(1.0, share + b.margin)
        aggs.append(F.percentile_approx(x, [lo, hi], ACCURACY).alias(name))
    row = df.agg(*aggs).first()
    for name, (c, b, inside, share) in todo.items():
        got = row[name]
        if got is not None:
            if share - b.margin > 0:
                b.lo = got[0]
            if share + b.margin < 1:
                b.hi = got[1]


def _counted(df: DataFrame, columns: dict, brackets: dict) -> DataFrame:
    """(name, part, v, cnt): per rank the number of values below its bracket
    (part 0) and the values inside it with their counts (part 1); part 2 is
    what lies above."""
    rows = F.array(*[F.struct(
        F.lit(name).alias("name"),
        F.when(b.inside(columns[c]), F.lit(1))
         .when(columns[c].isNotNull() & ((columns[c] < F.lit(b.lo)) if b.lo is not None else F.lit(False)), F.lit(0))
         .when(columns[c].isNotNull(), F.lit(2)).alias("part"),
        F.when(b.inside(columns[c]), columns[c]).alias("v")) for name, (c, b) in brackets.items()])
    return written(df.select(F.inline(rows)).where(F.col("part").isNotNull())
                   .groupBy("name", "part", "v").agg(F.count(F.lit(1)).alias("cnt")), "quantiles")


def quantiles_multi(df: DataFrame, spec: dict) -> DataFrame:
    """One-row DataFrame of exact quantiles.

    ``spec`` maps an output name to ``(column, p)``; a column is a name or an
    expression. NULL and NaN are ignored; a column without values gives NULL.
    """
    columns = {f"c{i}": F.nanvl(col_of(c).cast("double"), F.lit(None).cast("double"))
               for i, (c, _) in enumerate(spec.values())}
    names = {name: f"c{i}" for i, name in enumerate(spec)}
    brackets = {name: (names[name], _Bracket(float(p))) for name, (_, p) in spec.items()}
    _sketch(df, columns, {n: (c, b, None, b.p) for n, (c, b) in brackets.items()})
    done, todo = [], dict(brackets)
    ranks = {}
    while todo:
        counted = _counted(df, columns, todo)
        parts = {(r["name"], r["part"]): r for r in counted.groupBy("name", "part").agg(
            F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()}
        sketch, again, fine = {}, {}, []
        for name, (c, b) in todo.items():
            below, inside, above = (parts[name, k]["n"] if (name, k) in parts else 0 for k in range(3))
            n = below + inside + above
            pos = b.p * (n - 1)
            hit = not n or (below <= math.floor(pos) and math.ceil(pos) < below + inside)
            distinct = parts[name, 1]["distinct"] if (name, 1) in parts else 0
            if not hit:
                again[name] = (c, b)
                if b.good:  # narrowing went wrong: take the bracket before it
                    (b.lo, b.hi, _), b.last = b.good, True
                else:
                    b.margin, b.lo, b.hi = 8 * b.margin, None, None
                    sketch[name] = (c, b, None, b.p)
            elif distinct > MAX_BRACKET and not b.last and (not b.good or 2 * distinct < b.good[2]):
                again[name] = (c, b)
                sketch[name] = (c, b, b.inside(columns[c]), (pos - below) / max(1, inside - 1))
                b.good, b.margin = (b.lo, b.hi, distinct), 2.0 / ACCURACY
            else:
                fine.append(name)
                ranks[name] = (below, pos)
        if fine:
            done.append(counted.where(F.col("name").isin(fine) & (F.col("part") == 1)))
        if sketch:
            _sketch(df, columns, sketch)
        todo = again
    inside = done[0]
    for more in done[1:]:
        inside = inside.unionByName(more)
    run = F.sum("cnt").over(Window.partitionBy("name").orderBy("v"))
    ranked = inside.withColumn("start", run - F.col("cnt"))
    out = []
    for name in spec:
        below, pos = ranks[name]
        if pos < 0:
            out.append(F.lit(None).cast("double").alias(name))
            continue
        lo, hi = math.floor(pos), math.ceil(pos)

        def at(rank):
            k = F.lit(rank - below)
            return F.max(F.when((F.col("name") == name) & (F.col("start") <= k)
                                & (k < F.col("start") + F.col("cnt")), F.col("v")))
        out.append((at(lo) if lo == hi else F.lit(hi - pos) * at(lo) + F.lit(pos - lo) * at(hi)).alias(name))
    return ranked.agg(*out)


def exact_quantiles(df: DataFrame, column, probs, names=None) -> DataFrame:
    """One-row DataFrame with exact quantiles of one column."""
    probs = list(probs)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    return quantiles_multi(df, {n: (column, p) for n, p in zip(names, probs)})


def exact_median(df: DataFrame, column, name: str = "median") -> DataFrame:
    return exact_quantiles(df, column, [0.5], [name])


def approx_quantiles(df: DataFrame, column, probs, names=None, accuracy: int = 10_000) -> DataFrame:
    """A26 for very large data: one read, rank error at most 1 / accuracy."""
    names = list(names or [f"q{i}" for i in range(len(list(probs)))])
    return df.agg(*[F.percentile_approx(col_of(column), float(p), accuracy).alias(n)
                    for n, p in zip(names, probs)])


def modes(df: DataFrame, spec: dict) -> list[DataFrame]:
    """One-row frames, one for each type among the columns or expressions of
    ``spec`` ({name: column}): the most frequent non-null value of each (the
    smallest on ties; NULL without values), from one read per type."""
    types = df.select(*[col_of(c).alias(n) for n, c in spec.items()]).schema
    out = []
    for kind in dict.fromkeys(f.dataType.simpleString() for f in types):
        group = [n for n in spec if types[n].dataType.simpleString() == kind]
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), col_of(spec[n]).alias("v")) for n in group])
        counts = (df.select(F.inline(pairs)).where(F.col("v").isNotNull())
                  .groupBy("name", "v").agg(F.count(F.lit(1)).alias("cnt")))
        best = F.struct((-F.col("cnt")).alias("neg"), F.col("v"))
        one = counts.agg(*[F.min(F.when(F.col("name") == n, best)).alias(n) for n in group])
        out.append(one.select(*[F.col(f"{n}.v").alias(n) for n in group]))
    return out


def mode_value(df: DataFrame, column, name: str = "mode") -> DataFrame:
    """One-row frame with the most frequent non-null value (smallest
    value on ties); NULL when the column has no values."""
    return modes(df, {name: column})[0]
