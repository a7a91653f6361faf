"""Global statistics as literals.

A one-row aggregate (min/max, quantiles, means, rates) is run once and its
row, whose size does not depend on the data, becomes literals of the plan
that uses it. That plan then has neither a join nor a subquery for it, reads
its input once, and the literals take part in constant folding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_row(*one_row: DataFrame) -> dict[str, Column]:
    """The fields of the single row of each frame, by name, as literals of
    their types."""
    out = {}
    for df in one_row:
        row = df.first()
        for f in df.schema.fields:
            out[f.name] = F.lit(row[f.name]).cast(f.dataType)
    return out
