"""Sales and customer analytics (the reference's batch reports).

Every function is ``DataFrame(s) -> DataFrame`` over a *sales* frame with
columns ``customer_id, sale_date, category, product, quantity, price, total,
payment_method`` and a *customers* frame with ``customer_id, segment,
country, region, age``. Column names are keyword arguments.

Scale notes
-----------
* Reports that group by a customer attribute first aggregate the sales by
  ``customer_id`` (partial + final hash aggregate; a hot customer collapses
  map-side) and only then join the much smaller per-customer result to the
  customers. The join never sees individual sales, so a skewed customer
  cannot create a skewed join partition.
* Counting distinct customers after that pre-aggregation is a plain count:
  no ``count(DISTINCT)`` expansion, no second shuffle.
* Money is summed as DECIMAL; averages are exact sum / count at the end.
* Top-k results are at most k rows, so they are broadcast into the join
  with their dimension (the size bound is k, not the data).
* Reports that need only order attributes accept a frame pre-aggregated
  per order (``_lines`` = its number of sale rows); counts then sum
  ``_lines`` so the results are those of the line-level frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.labels import age_band, weekday_name_of
from martlake.functions.numeric import money, money_product, money_sum, ratio, to_double


LINES = "_lines"


def _n_sales(df: DataFrame) -> F.Column:
    """Number of sale rows: ``sum(_lines)`` on a frame pre-aggregated per
    order (see :func:`martlake.sources.tables.order_sales`), else ``count(*)``."""
    return F.sum(LINES) if LINES in df.columns else F.count(F.lit(1))


def _n_values(df: DataFrame, c: str) -> F.Column:
    """Number of non-NULL values of ``c`` counted in sale rows."""
    return F.sum(LINES) if LINES in df.columns else F.count(c)


def category_stats(sales: DataFrame, category="category", total="total", price="price",
                   quantity="quantity") -> DataFrame:
    """Count, total amount, average price, quantity and
    price x quantity revenue per category; largest total first."""
    return (sales.groupBy(category)
            .agg(F.count(F.lit(1)).alias("number_of_sales"),
                 money_sum(total).alias("_total"),
                 money_sum(price).alias("_price_sum"), F.count(price).alias("_price_n"),
                 money_sum(quantity).alias("_qty"),
                 F.sum(money_product(price, quantity)).alias("_rev"))
            .select(category, "number_of_sales",
                    to_double("_total").alias("total_sales_amount"),
                    ratio("_price_sum", "_price_n").alias("average_price"),
                    to_double("_qty").alias("total_quantity"),
                    to_double("_rev").alias("revenue"))
            .orderBy(F.desc("total_sales_amount"), F.asc(category)))


def _per_customer(sales: DataFrame, customer_id: str, extra_keys=(), total="total",
                  price="price", quantity="quantity") -> DataFrame:
    """Pre-aggregate sales to one row per customer (and extra keys)."""
    return (sales.groupBy(customer_id, *extra_keys)
            .agg(F.count(F.lit(1)).alias("_n"),
                 money_sum(total).alias("_total"),
                 money_sum(quantity).alias("_qty"),
                 F.sum(money_product(price, quantity)).alias("_rev"),
                 money_sum(price).alias("_price_sum"),
                 F.count(price).alias("_price_n")))


def region_stats(customers: DataFrame, sales: DataFrame, customer_id="customer_id",
                 region="region", total="total") -> DataFrame:
    """A2: per region distinct customers, sales, total, total per customer. A
    customer that is listed twice counts once; its sales join twice."""
    per_c = (sales.groupBy(customer_id)
             .agg(_n_sales(sales).alias("_n"), money_sum(total).alias("_total")))
    j = per_c.join(customers.select(customer_id, region), customer_id)
    return (j.groupBy(region)
            .agg(F.count_distinct(customer_id).alias("number_of_customers"),
                 F.sum("_n").alias("number_of_sales"),
                 F.sum("_total").alias("_total"))
            .select(region, "number_of_customers", "number_of_sales",
                    to_double("_total").alias("total_sales_amount"),
                    ratio("_total", "number_of_customers").alias("average_per_customer"))
            .orderBy(F.desc("total_sales_amount"), F.asc(region)))


def top_customers(customers: DataFrame, sales: DataFrame, k: int = 10,
                  customer_id="customer_id", total="total",
                  columns=("name", "segment", "country", "region")) -> DataFrame:
    """The k biggest spenders, then enriched with customer data.

    Ties on the spend are broken by the customer key so the k rows are
    deterministic; the final order is re-applied after the join.
    """
    top = (sales.groupBy(customer_id)
           .agg(_n_sales(sales).alias("number_of_purchases"),
                money_sum(total).alias("_spent"))
           .orderBy(F.desc("_spent"), F.asc(customer_id))
           .limit(k))
    return (customers.select(customer_id, *columns)
            .join(F.broadcast(top), customer_id)
            .select(customer_id, *columns, "number_of_purchases",
                    to_double("_spent").alias("total_spent"))
            .orderBy(F.desc("total_spent"), F.asc(customer_id)))


def time_stats(sales: DataFrame, sale_date="sale_date", total="total") -> DataFrame:
    """Per (year, month) count, total, average sale."""
    return (sales.groupBy(F.year(sale_date).alias("year"), F.month(sale_date).alias("month"))
            .agg(_n_sales(sales).alias("number_of_sales"),
                 money_sum(total).alias("_total"), _n_values(sales, total).alias("_n"))
            .select("year", "month", "number_of_sales",
                    to_double("_total").alias("total_sales_amount"),
                    ratio("_total", "_n").alias("average_sale_value"))
            .orderBy("year", "month"))


def payment_stats(sales: DataFrame, payment_method="payment_method", total="total") -> DataFrame:
    """A5: per payment method count, total, average."""
    return (sales.groupBy(payment_method)
            .agg(_n_sales(sales).alias("number_of_sales"),
                 money_sum(total).alias("_total"), _n_values(sales, total).alias("_n"))
            .select(payment_method, "number_of_sales",
                    to_double("_total").alias("total_amount"),
                    ratio("_total", "_n").alias("average_amount"))
            .orderBy(F.desc("total_amount"), F.asc(payment_method)))


def country_category(customers: DataFrame, sales: DataFrame, customer_id="customer_id",
                     country="country", category="category") -> DataFrame:
    """Per (country, category) count, total, average price; country
    ascending, total descending."""
    per_c = _per_customer(sales, customer_id, extra_keys=(category,))
    j = per_c.join(customers.select(customer_id, country), customer_id)
    return (j.groupBy(country, category)
            .agg(F.sum("_n").alias("number_of_sales"), F.sum("_total").alias("_total"),
                 F.sum("_price_sum").alias("_ps"), F.sum("_price_n").alias("_pn"))
            .select(country, category, "number_of_sales",
                    to_double("_total").alias("total_sales"),
                    ratio("_ps", "_pn").alias("average_price"))
            .orderBy(F.asc(country), F.desc("total_sales"), F.asc(category)))


def region_revenue(customers: DataFrame, sales: DataFrame, customer_id="customer_id",
                   region="region") -> DataFrame:
    """Per region quantity, price x quantity value, average price."""
    per_c = _per_customer(sales, customer_id)
    j = per_c.join(customers.select(customer_id, region), customer_id)
    return (j.groupBy(region)
            .agg(F.sum("_n").alias("number_of_sales"), F.sum("_qty").alias("_qty"),
                 F.sum("_rev").alias("_rev"), F.sum("_price_sum").alias("_ps"),
                 F.sum("_price_n").alias("_pn"))
            .select(region, "number_of_sales", to_double("_qty").alias("total_quantity"),
                    to_double("_rev").alias("revenue"),
                    ratio("_ps", "_pn").alias("average_price"))
            .orderBy(F.desc("revenue"), F.asc(region)))


def product_avg_price(sales: DataFrame, product="product", price="price") -> DataFrame:
    """Average sold price per product."""
    return (sales.groupBy(product)
            .agg(F.count(F.lit(1)).alias("number_of_sales"),
                 money_sum(price).alias("_ps"), F.count(price).alias("_pn"))
            .select(product, "number_of_sales", ratio("_ps", "_pn").alias("average_price"))
            .orderBy(F.desc("average_price"), F.asc(product)))


def segment_stats(customers: DataFrame, sales: DataFrame, customer_id="customer_id",
                  segment="segment", age="age") -> DataFrame:
    """Per segment transactions, revenue, average price and the average
    age over the joined sales rows (weighted by each customer's sales)."""
    per_c = _per_customer(sales, customer_id)
    j = per_c.join(customers.select(customer_id, segment, age), customer_id)
    return (j.groupBy(segment)
            .agg(F.sum("_n").alias("number_of_transactions"), F.sum("_rev").alias("_rev"),
                 F.sum("_price_sum").alias("_ps"), F.sum("_price_n").alias("_pn"),
                 F.sum(F.when(F.col(age).isNotNull(), F.col(age) * F.col("_n"))).alias("_age_sum"),
                 F.sum(F.when(F.col(age).isNotNull(), F.col("_n"))).alias("_age_n"))
            .select(segment, "number_of_transactions", to_double("_rev").alias("revenue"),
                    ratio("_ps", "_pn").alias("average_price"),
                    ratio("_age_sum", "_age_n").alias("average_age"))
            .orderBy(F.desc("revenue"), F.asc(segment)))


def segment_age(customers: DataFrame, segment="segment", age="age") -> DataFrame:
    """Average age and customer count per segment."""
    return (customers.groupBy(segment)
            .agg(ratio(F.sum(age), F.count(age)).alias("average_age"),
                 F.count(F.lit(1)).alias("number_of_customers"))
            .orderBy(segment))


def age_band_stats(customers: DataFrame, sales: DataFrame, customer_id="customer_id",
                   age="age") -> DataFrame:
    """Per age band transactions, revenue, average price."""
    per_c = _per_customer(sales, customer_id)
    j = per_c.join(customers.select(customer_id, age_band(age).alias("age_band")), customer_id)
    return (j.groupBy("age_band")
            .agg(F.sum("_n").alias("number_of_transactions"), F.sum("_rev").alias("_rev"),
                 F.sum("_price_sum").alias("_ps"), F.sum("_price_n").alias("_pn"))
            .select("age_band", "number_of_transactions", to_double("_rev").alias("revenue"),
                    ratio("_ps", "_pn").alias("average_price"))
            .orderBy("age_band"))


def monthly_base(customers: DataFrame, sales: DataFrame, customer_id="customer_id",
                 sale_date="sale_date", category="category", region="region",
                 as_double: bool = True) -> DataFrame:
    """The (year, month, category, region) base table. The region is
    joined first, since sales per customer, month and category are hardly
    fewer than the sales; the four-key result is small.

    ``as_double=False`` keeps the exact DECIMAL sums so a coarser report
    (A13) can re-aggregate it without drift.
    """
    j = sales.join(customers.select(customer_id, region), customer_id)
    out = (j.groupBy(F.year(sale_date).alias("year"), F.month(sale_date).alias("month"), category, region)
           .agg(F.count(F.lit(1)).alias("n_transactions"), money_sum("quantity").alias("total_quantity"),
                F.sum(money_product("price", "quantity")).alias("revenue")))
    return monthly_as_double(out) if as_double else out


def monthly_as_double(base: DataFrame) -> DataFrame:
    """A12 for a reader: the exact sums as DOUBLE."""
    return base.select(*[c for c in base.columns if c not in ("total_quantity", "revenue")],
                       to_double("total_quantity").alias("total_quantity"), to_double("revenue").alias("revenue"))


_MONTHLY_SUMS = {"n_transactions": "bigint", "total_quantity": "decimal(28,6)", "revenue": "decimal(38,12)"}


def _monthly_types(base: DataFrame) -> DataFrame:
    return base.select("year", "month", *[c for c in base.columns if c not in ("year", "month", *_MONTHLY_SUMS)],
                       *[F.col(c).cast(t).alias(c) for c, t in _MONTHLY_SUMS.items()])


def write_monthly(base: DataFrame, path: str) -> None:
    """A12 as a table that is kept: the exact monthly sums, one folder a month."""
    _monthly_types(base).write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_monthly(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def refresh_monthly(spark, path: str, delta: DataFrame, sign: int = 1) -> None:
    """A12 kept up: adds the monthly sums of new sales (``sign`` -1: takes away
    those of sales that were taken back) to the table, without the sales it was
    made of. Only the months of ``delta`` are read and replaced; a month's sums
    are exact, so the table equals a rebuild. A combination without a sale left
    goes."""
    delta = _monthly_types(delta)
    keys = [c for c in delta.columns if c not in _MONTHLY_SUMS]
    months = [r["year"] * 100 + r["month"] for r in delta.select("year", "month").distinct().collect()]
    if not months:
        return
    old = read_monthly(spark, path).where((F.col("year") * 100 + F.col("month")).isin(months))
    change = delta.select(*keys, *[(F.col(c) * sign).cast(t).alias(c) for c, t in _MONTHLY_SUMS.items()])
    merged = (old.unionByName(change).groupBy(*keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in _MONTHLY_SUMS.items()])
              .where(F.col("n_transactions") != 0))
    month = F.col("year") * 100 + F.col("month")
    # A month without rows has no folder that could be overwritten.
    left = months if sign > 0 else [r["m"] for r in merged.select(month.alias("m")).distinct().collect()]
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    for m in set(months) - set(left):
        _drop_folder(spark, f"{path.rstrip('/')}/year={m // 100}/month={m % 100}")


def _drop_folder(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def monthly_by_region(base: DataFrame, region="region") -> DataFrame:
    """The monthly base table re-aggregated to (region, year, month)."""
    return (base.groupBy(region, "year", "month")
            .agg(F.sum("revenue").alias("_rev"), F.sum("total_quantity").alias("_qty"))
            .select(region, "year", "month", to_double("_rev").alias("revenue"),
                    to_double("_qty").alias("total_quantity"))
            .orderBy(region, "year", "month"))


def top_products(sales: DataFrame, k: int = 5, product="product") -> DataFrame:
    """Top-k products by price x quantity revenue (name breaks ties)."""
    return (sales.groupBy(product)
            .agg(F.sum(money_product("price", "quantity")).alias("_rev"),
                 money_sum("quantity").alias("_qty"))
            .orderBy(F.desc("_rev"), F.asc(product))
            .limit(k)
            .select(product, to_double("_rev").alias("revenue"),
                    to_double("_qty").alias("total_quantity")))


def segment_category_customers(customers: DataFrame, sales: DataFrame,
                               customer_id="customer_id", segment="segment",
                               category="category") -> DataFrame:
    """Per (segment, category) revenue and distinct customers."""
    per_c = (sales.groupBy(customer_id, category)
             .agg(F.sum(money_product("price", "quantity")).alias("_rev")))
    j = per_c.join(customers.select(customer_id, segment), customer_id)
    return (j.groupBy(segment, category)
            .agg(F.sum("_rev").alias("_rev"), F.count_distinct(customer_id).alias("number_of_customers"))
            .select(segment, category, to_double("_rev").alias("revenue"), "number_of_customers")
            .orderBy(F.asc(segment), F.desc("revenue"), F.asc(category)))


def weekday_stats(sales: DataFrame, sale_date="sale_date") -> DataFrame:
    """Per day of week (1 = Sunday) transactions and revenue."""
    return (sales.groupBy(F.dayofweek(sale_date).alias("day_number"))
            .agg(F.count(F.lit(1)).alias("number_of_transactions"),
                 F.sum(money_product("price", "quantity")).alias("_rev"))
            .select(weekday_name_of("day_number").alias("day"),
                    "day_number", "number_of_transactions", to_double("_rev").alias("revenue"))
            .orderBy("day_number"))


def category_revenue_rounded(sales: DataFrame, category="category") -> DataFrame:
    """After the product join, count and revenue rounded to 2."""
    return (sales.groupBy(category)
            .agg(F.count(F.lit(1)).alias("number_of_sales"),
                 F.sum(money_product("price", "quantity")).alias("_rev"))
            .select(category, "number_of_sales",
                    F.round(F.col("_rev"), 2).cast("double").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc(category)))


def month_text_stats(sales: DataFrame, sale_date="sale_date") -> DataFrame:
    """Grouped by the zero-padded month text only (years merge, as in
    the reference)."""
    return (sales.groupBy(F.date_format(sale_date, "MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("number_of_sales"),
                 F.sum(money_product("price", "quantity")).alias("_rev"))
            .select("month", "number_of_sales", to_double("_rev").alias("revenue"))
            .orderBy("month"))


def month_over_month(sales: DataFrame, category="category", sale_date="sale_date") -> DataFrame:
    """Monthly revenue per category with the previous month's value
    and the change. The window runs over the already aggregated months and
    is partitioned by category."""
    from pyspark.sql import Window
    monthly = (sales.groupBy(category, F.year(sale_date).alias("year"),
                             F.month(sale_date).alias("month"))
               .agg(F.sum(money_product("price", "quantity")).alias("_rev")))
    w = Window.partitionBy(category).orderBy("year", "month")
    return (monthly
            .withColumn("_prev", F.lag("_rev").over(w))
            .select(category, "year", "month", to_double("_rev").alias("revenue"),
                    to_double("_prev").alias("previous_revenue"),
                    to_double(F.col("_rev") - F.col("_prev")).alias("change"),
                    ratio(F.col("_rev") - F.col("_prev"), F.col("_prev")).alias("change_ratio"))
            .orderBy(category, "year", "month"))


def customer_order_summary(customers: DataFrame, orders: DataFrame, customer_id="customer_id",
                           amount="amount", order_date="order_date") -> DataFrame:
    """Per customer total orders, amount, average order, last order
    date; customers without orders keep 0 orders and NULL amounts."""
    per_c = (orders.groupBy(customer_id)
             .agg(F.count(F.lit(1)).alias("total_orders"), money_sum(amount).alias("_amt"),
                  F.max(order_date).alias("last_order_date")))
    return (customers.select(customer_id).join(per_c, customer_id, "left")
            .select(customer_id,
                    F.coalesce(F.col("total_orders"), F.lit(0)).alias("total_orders"),
                    to_double("_amt").alias("total_amount"),
                    ratio("_amt", "total_orders").alias("avg_order_amount"),
                    "last_order_date"))


def category_product_summary(products: DataFrame, category="category", price="price") -> DataFrame:
    """Product count and average price rounded to 2 per category."""
    return (products.groupBy(category)
            .agg(F.count(F.lit(1)).alias("product_count"),
                 money_sum(price).alias("_ps"), F.count(price).alias("_pn"))
            .select(category, "product_count",
                    F.round(ratio("_ps", "_pn"), 2).alias("average_price"))
            .orderBy(category))


def filtered_group_counts(df: DataFrame, condition, key="category") -> DataFrame:
    """``groupBy(key).count()`` after a filter."""
    return df.filter(condition).groupBy(key).count().orderBy(key)


def order_value_stats(sales: DataFrame, order_id="order_id", total="total") -> DataFrame:
    """Average order value and average lines per order (order totals
    first, one row per order, then a global aggregate)."""
    per_order = sales.groupBy(order_id).agg(money_sum(total).alias("_v"),
                                             F.count(F.lit(1)).alias("_lines"))
    return per_order.agg(F.count(F.lit(1)).alias("orders"),
                         ratio(F.sum("_v"), F.count(F.lit(1))).alias("avg_order_value"),
                         ratio(F.sum("_lines"), F.count(F.lit(1))).alias("avg_lines_per_order"))


def avg_order_size_by_category(sales: DataFrame, category="category", quantity="quantity") -> DataFrame:
    """Average quantity per sale line in each category."""
    return (sales.groupBy(category)
            .agg(ratio(money_sum(quantity), F.count(quantity)).alias("avg_quantity"),
                 F.count(F.lit(1)).alias("number_of_sales"))
            .orderBy(F.desc("avg_quantity"), F.asc(category)))


def first_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """O3: a plain LIMIT without ordering (which rows is not defined; for
    inspection only, never for a report)."""
    return df.limit(n)
