"""Exact numeric helpers.

Money and quantities are summed as DECIMAL so that a result does not depend
on how rows were split into partitions (double sums change in the last bits
with the order of addition) and so that re-running a lost stage gives the
same answer. Ratios are taken as DOUBLE / DOUBLE at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type of money and quantity columns: six decimals, so that prices below a
# cent add up, in the 18 digits that Spark keeps in a long. A product of two
# is exact in DECIMAL(37,12).
MONEY = "decimal(18,6)"
# Type used to accumulate generic doubles (values up to 1e27, each to ten
# decimals; what a value has beyond them is rounded before it is added).
ACCUM = "decimal(38,10)"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast to the DECIMAL of money and quantities."""
    return col_of(c).cast(MONEY)


def money_sum(c) -> Column:
    """Exact sum of a money or quantity column, as DECIMAL."""
    return F.sum(money(c))


def exact_sum(c) -> Column:
    """Order-independent sum of a double column, each value to ten decimals, as DECIMAL."""
    return F.sum(col_of(c).cast(ACCUM))


def to_double(c) -> Column:
    return col_of(c).cast("double")


def ratio(num, den) -> Column:
    """num / den in DOUBLE; NULL when the denominator is 0 or NULL."""
    return F.try_divide(to_double(num), to_double(den))


def exact_mean(c) -> Column:
    """Mean of a double column from the order-independent sum of its values to
    ten decimals; NULL for no values."""
    return ratio(exact_sum(c), F.count(col_of(c)))


def money_product(a, b) -> Column:
    """a * b computed exactly in DECIMAL (price x quantity)."""
    return money(a) * money(b)
