"""Scaling, outliers and derived features.

Plan-time schema: the reference adds ``<c>_normalized`` only when
max > min and ``<c>_outlier`` only when an outlier exists. A Spark plan
needs its schema before it runs, so both columns are always emitted:
``<c>_normalized`` is NULL for a constant column and ``<c>_outlier`` is
false when there is no outlier (and the column is left unchanged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.numeric import exact_mean, exact_sum, ratio
from martlake.functions.scalars import scalar_row
from martlake.operators.stats import exact_median, quantiles_multi
from martlake.session import written


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric (not boolean) columns that are not ``id`` / ``*_id``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType)
            and not (f.name == "id" or f.name.endswith("_id"))]


def normalize_numeric_columns(df: DataFrame) -> DataFrame:
    """``<c>_normalized = (c - min) / (max - min)`` from one aggregate
    over all columns; NULL when the column is constant."""
    cols = numeric_columns(df)
    if not cols:
        return df
    stats = scalar_row(df.agg(*[e for c in cols for e in
                                (F.min(F.col(c).cast("double")).alias(f"_min_{c}"),
                                 F.max(F.col(c).cast("double")).alias(f"_max_{c}"))]))
    new = []
    for c in cols:
        lo, hi = stats[f"_min_{c}"], stats[f"_max_{c}"]
        new.append(F.when(hi > lo, (F.col(c).cast("double") - lo) / (hi - lo))
                   .alias(f"{c}_normalized"))
    return df.select(*df.columns, *new)


def handle_outliers(df: DataFrame, method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """C4: flag outliers per numeric column and replace them by the column
    median (taken over all values, outliers included).

    iqr:    x < Q1 - k*IQR or x > Q3 + k*IQR
    zscore: |x - mean| / std > k (sample std; std = 0 flags nothing)
    NULL is never an outlier. Processed columns become DOUBLE.
    """
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method {method!r}")
    cols = numeric_columns(df)
    if not cols:
        return df
    spec = {f"_med_{c}": (c, 0.5) for c in cols}
    if method == "iqr":
        spec.update({f"_q1_{c}": (c, 0.25) for c in cols})
        spec.update({f"_q3_{c}": (c, 0.75) for c in cols})
    # all statistics of all columns: one row each, read as literals
    q = scalar_row(quantiles_multi(df, spec))
    if method == "zscore":
        m = scalar_row(df.agg(*[e for c in cols for e in
                                (exact_mean(c).alias(f"_mean_{c}"),
                                 F.stddev_samp(F.col(c).cast("double")).alias(f"_std_{c}"))]))
    out = []
    flags = []
    for c in cols:
        x = F.col(c).cast("double")
        if method == "iqr":
            q1, q3 = q[f"_q1_{c}"], q[f"_q3_{c}"]
            iqr = q3 - q1
            is_out = (x < q1 - F.lit(threshold) * iqr) | (x > q3 + F.lit(threshold) * iqr)
        else:
            z = F.abs(F.try_divide(x - m[f"_mean_{c}"], m[f"_std_{c}"]))
            is_out = z > F.lit(threshold)
        is_out = F.coalesce(is_out, F.lit(False))
        out.append((c, F.when(is_out, q[f"_med_{c}"]).otherwise(x)))
        flags.append(is_out.alias(f"{c}_outlier"))
    replaced = dict(out)
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns],
                     *flags)


def word_count(text) -> F.Column:
    """Whitespace token count: NULL -> NULL, '' or blanks -> 0."""
    t = F.regexp_replace(F.col(text) if isinstance(text, str) else text,
                         r"^(?U)\s+|(?U)\s+$", "")
    return F.when(t.isNull(), F.lit(None).cast("int")) \
        .when(t == "", F.lit(0)) \
        .otherwise(F.size(F.split(t, r"(?U)\s+")))


#: Groups whose means are broadcast to the rows (a few MB); beyond that the
#: rows are joined to them by shuffle.
BROADCAST_GROUPS = 100_000


def group_mean(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean of ``value`` per ``key`` attached to every row; NULL
    for a NULL key. The means are aggregated (combined map-side), written
    once and counted. Up to ``BROADCAST_GROUPS`` they are broadcast, so the
    rows are not shuffled; beyond, rows with a key are joined by shuffle (AQE
    splits hot keys) and rows without one stay out of the join."""
    means = written(df.where(F.col(key).isNotNull()).groupBy(key)
                    .agg(ratio(exact_sum(value), F.count(value)).alias(name)), "group-means")
    if means.count() <= BROADCAST_GROUPS:
        return df.join(F.broadcast(means), key, "left").select(*df.columns, name)
    keyed = df.where(F.col(key).isNotNull()).join(means, key, "left").select(*df.columns, name)
    return keyed.unionByName(df.where(F.col(key).isNull()).withColumn(name, F.lit(None).cast("double")))


def generate_features(df: DataFrame, price="price", description="description",
                      category="category") -> DataFrame:
    """is_expensive, description_word_count, category_avg_price,
    price_to_category_avg (each only when its input columns exist)."""
    out = df
    cols = df.columns
    extra = []
    if price in cols:
        med = scalar_row(exact_median(df, price, "_median_price"))["_median_price"]
        extra.append(F.coalesce(F.col(price) > med, F.lit(False)).alias("is_expensive"))
    if description in cols:
        extra.append(word_count(description).alias("description_word_count"))
    if category in cols and price in cols:
        out = group_mean(out, category, price, "category_avg_price")
        extra += [F.col("category_avg_price"),
                  F.try_divide(F.col(price).cast("double"), F.col("category_avg_price"))
                  .alias("price_to_category_avg")]
    return out.select(*cols, *extra)


def booleans_to_double(df: DataFrame, columns=None) -> DataFrame:
    """Boolean feature columns as 1.0 / 0.0 (NULL stays NULL) before a
    load into a store without a boolean type."""
    cols = set(columns or [f.name for f in df.schema.fields
                           if isinstance(f.dataType, T.BooleanType)])
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def apply_transformations(df: DataFrame, materialize: bool = True) -> DataFrame:
    """Normalize -> outliers (iqr, 1.5) -> features; each stage's
    statistics are taken over the previous stage's output, so the outlier
    stage also processes the new ``*_normalized`` columns.

    Every stage reads its input for the statistics and for the rows, so with
    ``materialize`` each stage's output is written once as Parquet into the
    shared scratch folder: the next stage reads only the columns it needs.
    """
    def cut(frame: DataFrame) -> DataFrame:
        return written(frame, "features") if materialize else frame

    stage1 = cut(normalize_numeric_columns(df))
    stage2 = cut(handle_outliers(stage1))
    return generate_features(stage2)
