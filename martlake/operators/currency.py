"""Currency enrichment.

Rates arrive as a document ``{"rates": {"USD": 1.1, ...}}`` relative to a
base currency. They are turned into a tiny ``(currency, rate)`` frame, whose
one-row pivot is read as literals of the projection, so converting N rows
never shuffles or joins them.

The set of currency codes decides the output *schema* (one column per target),
so its distinct codes are read at plan time, in code order; callers that know
their codes pass them.

A price is multiplied by its rate on the decimal values that the doubles show
(price as DECIMAL(21,8), rate as DECIMAL(30,18), so that small rates keep their
digits) and the product is rounded half-up to 2 decimals: 1.005 at rate 1 gives
1.01, 12.345 at 160.25 gives 1978.29 and 10,000,000 at 0.0000392123 gives 392.12.
Spark holds the product to 12 decimals before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.numeric import col_of
from martlake.functions.scalars import scalar_row

PRICE_TYPE = "decimal(21,8)"
RATE_TYPE = "decimal(30,18)"


def rates_from_documents(docs: DataFrame, column: str = "value") -> DataFrame:
    """JSON rate documents -> (currency, rate); a document without a
    ``rates`` key contributes nothing."""
    parsed = docs.select(F.from_json(F.col(column), "rates map<string,double>").alias("d"))
    return (parsed.select(F.explode(F.col("d.rates")).alias("currency", "rate"))
            .where(F.col("currency").isNotNull()))


def rates_from_json_files(spark: SparkSession, path: str) -> DataFrame:
    """Rate documents stored as JSON files (one document per file, may
    span lines) -> (currency, rate)."""
    docs = spark.read.schema("rates map<string,double>").option("multiLine", True).json(path)
    return (docs.select(F.explode(F.col("rates")).alias("currency", "rate"))
            .where(F.col("currency").isNotNull()))


def rates_frame(spark: SparkSession, rates: dict) -> DataFrame:
    """In-memory rates (S13) as (currency, rate)."""
    return spark.createDataFrame([(k, float(v)) for k, v in rates.items()],
                                 "currency string, rate double")


def available_currencies(rates: DataFrame, base: str) -> list[str]:
    """The distinct codes of the rates frame in code order, with the base
    currency appended when absent (its rate is 1.0)."""
    codes = [r.currency for r in rates.select("currency").distinct().orderBy("currency").collect()]
    return codes if base in codes else [*codes, base]


def convert(price, rate) -> Column:
    """C11: price x rate, rounded half-up to 2 decimals, as DOUBLE."""
    return F.round(col_of(price).cast(PRICE_TYPE) * col_of(rate).cast(RATE_TYPE), 2).cast("double")


def _rate_row(rates: DataFrame, targets: list[str]) -> DataFrame:
    """One row, one column per target code. A code listed twice keeps its
    largest rate, so the result does not depend on row order."""
    return rates.groupBy().pivot("currency", targets).agg(F.max("rate"))


def enrich_with_currency(df: DataFrame, rates: DataFrame, price_column: str = "price",
                         target_currencies=None, base_currency: str = "EUR",
                         strict: bool = True) -> DataFrame:
    """C8 (strict) / C9 (tolerant): add ``<price>_currency`` (the base code)
    and one ``<price>_<CUR>`` column per target currency other than the base.

    strict: an unknown target raises ``ValueError``.
    tolerant: unknown targets are dropped; if none is left only the base
    currency is used (so only ``<price>_currency`` is added).
    """
    if price_column not in df.columns:
        raise ValueError(f"column '{price_column}' does not exist")
    codes = available_currencies(rates, base_currency)
    if target_currencies is None:
        targets = list(codes)
    elif strict:
        missing = [c for c in target_currencies if c not in codes]
        if missing:
            raise ValueError(f"no rate for {', '.join(missing)}; the rates have {', '.join(codes)}")
        targets = list(target_currencies)
    else:
        targets = [c for c in target_currencies if c in codes] or [base_currency]
    convert_to = [c for c in targets if c != base_currency]
    out = df.withColumn(f"{price_column}_currency", F.lit(base_currency))
    if not convert_to:
        return out
    rate = scalar_row(_rate_row(rates, convert_to).select(
        *[F.col(c).alias(f"_rate_{c}") for c in convert_to]))   # one row
    return out.select(*df.columns, f"{price_column}_currency",
                      *[convert(price_column, rate[f"_rate_{c}"]).alias(f"{price_column}_{c}")
                        for c in convert_to])


def add_currency_info(df: DataFrame, rates: DataFrame, base_currency: str = "EUR",
                      rates_date: str = "1970-01-01") -> DataFrame:
    """Constant metadata columns. The rate date is a parameter (the
    reference stamps the wall clock, which makes reruns differ)."""
    codes = available_currencies(rates, base_currency)
    return (df.withColumn("available_currencies", F.lit(str(codes)))
            .withColumn("base_currency", F.lit(base_currency))
            .withColumn("currency_rates_date", F.lit(rates_date)))


def transform(df: DataFrame, rates: DataFrame, price_column: str = "price",
              target_currencies=None, base_currency: str = "EUR", strict: bool = True,
              add_currency_metadata: bool = True, rates_date: str = "1970-01-01") -> DataFrame:
    """Price cast to DOUBLE (strict: a non-numeric price raises under ANSI),
    enrichment, then metadata."""
    if price_column not in df.columns:
        raise ValueError(f"column '{price_column}' does not exist")
    df = df.withColumn(price_column, F.col(price_column).cast("double"))
    out = enrich_with_currency(df, rates, price_column, target_currencies, base_currency, strict)
    if add_currency_metadata:
        out = add_currency_info(out, rates, base_currency, rates_date)
    return out
