"""Row predicates with explicit NULL handling (three-valued logic made
two-valued where the reference's pandas code treats NULL as a value)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake.functions.numeric import col_of


def null_or_empty(c) -> Column:
    x = col_of(c)
    return x.isNull() | (x == F.lit(""))


def not_in(c, values) -> Column:
    """True when the value is outside ``values``; NULL counts as outside."""
    return ~F.coalesce(col_of(c).isin(list(values)), F.lit(False))


def shorter_or_null(c, n: int) -> Column:
    x = col_of(c)
    return x.isNull() | (F.length(x) < n)


def definitely(cond: Column) -> Column:
    """NULL -> False."""
    return F.coalesce(cond, F.lit(False))
