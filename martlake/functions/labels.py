"""Built-in CASE expressions for the reference's label rules.

All are plain ``when`` chains so they stay inside whole-stage codegen; none
needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake.functions.numeric import col_of

# Labels and names the reference emits.
AGE_BAND_LABELS = ["18-29", "30-39", "40-49", "50+"]
PRICE_TIER_LABELS = ["Nízká", "Střední", "Vysoká"]
# Day names indexed by DAYOFWEEK (1 = Sunday ... 7 = Saturday).
WEEKDAY_NAMES = ["Neděle", "Pondělí", "Úterý", "Středa", "Čtvrtek", "Pátek", "Sobota"]
SENSOR_LABELS = ["high temperature", "high humidity", "normal"]
STOCK_LABELS = ["out of stock", "low stock", "in stock"]


def age_band(age) -> Column:
    """<30, 30-39, 40-49, otherwise 50+ (a NULL age falls to 50+)."""
    a = col_of(age)
    out = F
    for below, label in zip((30, 40, 50), AGE_BAND_LABELS):
        out = out.when(a < below, F.lit(label))
    return out.otherwise(F.lit(AGE_BAND_LABELS[3]))


def price_tier(price) -> Column:
    """<50 low, <200 middle, otherwise high; NULL price gives NULL."""
    p = col_of(price)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p < 50, F.lit(PRICE_TIER_LABELS[0]))
            .when(p < 200, F.lit(PRICE_TIER_LABELS[1]))
            .otherwise(F.lit(PRICE_TIER_LABELS[2])))


def weekday_name(ts) -> Column:
    """Day name from DAYOFWEEK (1 = Sunday)."""
    return weekday_name_of(F.dayofweek(col_of(ts)))


def weekday_name_of(day_number) -> Column:
    """Day name from a DAYOFWEEK number (1 = Sunday)."""
    d = col_of(day_number)
    expr = None
    for i, name in enumerate(WEEKDAY_NAMES, start=1):
        expr = F.when(d == i, F.lit(name)) if expr is None else expr.when(d == i, F.lit(name))
    return expr


def flag01(cond: Column) -> Column:
    """Boolean condition to 1/0 (NULL condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def sensor_condition(temperature, humidity) -> Column:
    """temperature > 30 first, then humidity > 70, else normal."""
    return (F.when(col_of(temperature) > 30, F.lit(SENSOR_LABELS[0]))
            .when(col_of(humidity) > 70, F.lit(SENSOR_LABELS[1]))
            .otherwise(F.lit(SENSOR_LABELS[2])))


def stock_status(stock) -> Column:
    s = col_of(stock)
    return (F.when(s == 0, F.lit(STOCK_LABELS[0]))
            .when(s < 10, F.lit(STOCK_LABELS[1]))
            .otherwise(F.lit(STOCK_LABELS[2])))


def category_from_type(type_col, mapping: dict[str, list[str]], default: str = "Other") -> Column:
    """Category by membership of a product type in per-category lists."""
    t = col_of(type_col)
    expr = None
    for cat, members in mapping.items():
        cond = t.isin(list(members))
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
