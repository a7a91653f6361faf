"""Column profiles in one pass (A14 ``describe``, A24 null counts).

Both are a single aggregate over the frame (all columns at once, combined
map-side) followed by an unpivot of its one row into long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, NumericType

from martlake.functions.numeric import exact_mean

STD_DIGITS = 6


def describe_long(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, count, mean, stddev, min, max, min_text, max_text) per
    column: numbers have the numeric fields, all others (strings, dates,
    booleans) their count and the texts of their smallest and largest value.

    mean is exact (decimal accumulation); the sample stddev is rounded to
    6 decimals because its last bits depend on the order of accumulation.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(columns or [c for c, t in types.items() if isinstance(t, AtomicType)])
    aggs = []
    for i, c in enumerate(cols):
        if isinstance(types[c], NumericType):
            x, text = F.col(c).cast("double"), F.lit(None).cast("string")
        else:
            x, text = F.lit(None).cast("double"), F.col(c)
        aggs += [F.count(c).alias(f"n{i}"), exact_mean(x).alias(f"m{i}"),
                 F.round(F.stddev_samp(x), STD_DIGITS).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.min(text).cast("string").alias(f"a{i}"), F.max(text).cast("string").alias(f"z{i}")]
    one = df.agg(*aggs)
    names = {"n": "count", "m": "mean", "s": "stddev", "lo": "min", "hi": "max", "a": "min_text", "z": "max_text"}
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}{i}").alias(v) for k, v in names.items()])
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column."""
    cols = df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows))
