"""Basic cleaning: column names, duplicates, missing values.

The statistics a fill needs are one-row aggregates, taken for all columns
together and read as literals in the final projection: no join, no subquery
and no driver-side loop over the data.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.numeric import exact_mean
from martlake.functions.scalars import scalar_row
from martlake.operators.stats import modes, quantiles_multi

log = logging.getLogger(__name__)

FILL_METHODS = ("drop", "mean", "median", "mode", "zero", "empty_string")


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def clean_column_names(df: DataFrame) -> DataFrame:
    """strip -> lower -> each blank to ``_``; refuses names that collide."""
    new = [clean_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"column names collide after cleaning: {dup}")
    return df.toDF(*new)


def drop_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """Whole-row (or subset) de-duplication; NULLs compare equal.

    With a subset the kept row is arbitrary (as in Spark); use
    :func:`keep_first` for a deterministic choice.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def keep_first(df: DataFrame, subset, order_by: str) -> DataFrame:
    """One row per ``subset`` key, the one with the smallest ``order_by``.

    Written as ``min_by`` aggregation rather than ``row_number`` over a
    window: the aggregate combines map-side, so a key holding a large share
    of the rows never has to be sorted inside one task.
    """
    subset = list(subset)
    rest = [c for c in df.columns if c not in subset and c != order_by]
    # struct ordering compares its first field first, so min(struct(order, ...))
    # is the row with the smallest order key (ties broken by the other fields).
    best = F.min(F.struct(F.col(order_by).alias("_k"), *[F.col(c) for c in rest])).alias("_best")
    out = df.groupBy(*subset).agg(best)
    return out.select(*subset, F.col("_best._k").alias(order_by),
                      *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def _is_numeric(dt) -> bool:
    return isinstance(dt, T.NumericType)


def handle_missing_values(df: DataFrame, strategy: dict) -> DataFrame:
    """Apply ``{column: method}`` in dictionary order.

    Methods: drop, mean, median, mode, zero, empty_string. Each step sees
    the rows left by the ``drop`` steps before it, so its statistic is taken
    over those rows only. Unknown columns or methods, and mean/median on a
    non-numeric column, are skipped with a warning. A column without NULLs
    is unchanged by any fill.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    drops: list[str] = []
    fills: dict[str, object] = {}      # column -> Column, or (type, statistic)
    means, medians, mode_of = {}, {}, {}

    def kept(column: str):
        """The column in the rows that the drops so far leave, else NULL."""
        cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in drops], F.lit(True))
        return F.when(cond, F.col(column))

    for i, (column, method) in enumerate(strategy.items()):
        if column not in types:
            log.warning("column %s does not exist", column)
            continue
        if method not in FILL_METHODS:
            log.warning("unknown method %r for column %s", method, column)
            continue
        dt = types[column]
        stat = f"_stat{i}"
        if method == "drop":
            drops.append(column)
        elif method in ("mean", "median") and not _is_numeric(dt):
            log.warning("column %s is not numeric; %s skipped", column, method)
        elif method == "mean":
            means[stat] = kept(column)
            fills[column] = ("double", stat)
        elif method == "median":
            medians[stat] = (kept(column), 0.5)
            fills[column] = ("double", stat)
        elif method == "mode":
            mode_of[stat] = kept(column)
            fills[column] = (None, stat)
        elif method == "zero":
            fills[column] = F.coalesce(F.col(column), F.lit(0).cast(dt))
        elif method == "empty_string":
            if isinstance(dt, T.StringType):
                fills[column] = F.coalesce(F.col(column), F.lit(""))
            else:
                log.warning("column %s is not a string; empty_string skipped", column)
    frames = modes(df, mode_of) if mode_of else []
    if means:
        frames.append(df.agg(*[exact_mean(x).alias(stat) for stat, x in means.items()]))
    if medians:
        frames.append(quantiles_multi(df, medians))
    scalars = scalar_row(*frames)

    def resolve(column):
        f = fills[column]
        if not isinstance(f, tuple):
            return f
        cast, stat = f
        x = F.col(column).cast(cast) if cast else F.col(column)
        return F.coalesce(x, scalars[stat])

    out = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in drops])) if drops else df
    return out.select(*[resolve(c).alias(c) if c in fills else F.col(c) for c in df.columns])
