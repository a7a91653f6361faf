"""Sales analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import sales as S
from martlake.plans.registry import query
from martlake.plans.sql_helpers import CUSTOMERS, PRODUCTS, SALES, dec, mprod, msum, ratio, with_
from martlake.session import scratch_path
from martlake.sources import tables as T


def _sc(spark, d):
    return T.sales(spark, d), T.customers(spark, d)


@query("sales_by_category", with_(SALES) + f"""
SELECT category, COUNT(*) AS number_of_sales, {msum('total')} AS total_sales_amount,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price,
       {msum('quantity')} AS total_quantity,
       CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue
FROM sales GROUP BY category ORDER BY total_sales_amount DESC, category""")
def sales_by_category(spark, d):
    return S.category_stats(T.sales(spark, d, with_orders=False))


@query("region_stats", with_(SALES, CUSTOMERS) + f"""
SELECT region, COUNT(DISTINCT s.customer_id) AS number_of_customers,
       COUNT(*) AS number_of_sales, {msum('total')} AS total_sales_amount,
       {ratio('SUM(' + dec('total') + ')', 'COUNT(DISTINCT s.customer_id)')} AS average_per_customer
FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY region ORDER BY total_sales_amount DESC, region""")
def region_stats(spark, d):
    s, c = T.order_sales(spark, d), T.customers(spark, d)
    return S.region_stats(c, s)


@query("top_customers", with_(SALES, CUSTOMERS) + f"""
, top AS (
  SELECT customer_id, COUNT(*) AS number_of_purchases, SUM({dec('total')}) AS spent
  FROM sales GROUP BY customer_id ORDER BY spent DESC, customer_id LIMIT 10)
SELECT c.customer_id, name, segment, country, region, number_of_purchases,
       CAST(spent AS DOUBLE) AS total_spent
FROM top JOIN customers c ON top.customer_id = c.customer_id
ORDER BY total_spent DESC, customer_id""")
def top_customers(spark, d):
    s, c = T.order_sales(spark, d), T.customers(spark, d)
    return S.top_customers(c, s, k=10)


@query("sales_by_month", with_(SALES) + f"""
SELECT CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
       COUNT(*) AS number_of_sales, {msum('total')} AS total_sales_amount,
       {ratio('SUM(' + dec('total') + ')', 'COUNT(total)')} AS average_sale_value
FROM sales GROUP BY 1, 2 ORDER BY 1, 2""")
def sales_by_month(spark, d):
    return S.time_stats(T.order_sales(spark, d))


@query("payment_stats", with_(SALES) + f"""
SELECT payment_method, COUNT(*) AS number_of_sales, {msum('total')} AS total_amount,
       {ratio('SUM(' + dec('total') + ')', 'COUNT(total)')} AS average_amount
FROM sales GROUP BY payment_method ORDER BY total_amount DESC, payment_method""")
def payment_stats(spark, d):
    return S.payment_stats(T.order_sales(spark, d))


@query("country_category", with_(SALES, CUSTOMERS) + f"""
SELECT country, category, COUNT(*) AS number_of_sales, {msum('total')} AS total_sales,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price
FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY country, category ORDER BY country, total_sales DESC, category""")
def country_category(spark, d):
    s, c = _sc(spark, d)
    return S.country_category(c, s)


@query("region_revenue", with_(SALES, CUSTOMERS) + f"""
SELECT region, COUNT(*) AS number_of_sales, {msum('quantity')} AS total_quantity,
       CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price
FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY region ORDER BY revenue DESC, region""")
def region_revenue(spark, d):
    s, c = _sc(spark, d)
    return S.region_revenue(c, s)


@query("product_avg_price", with_(SALES) + f"""
SELECT product, COUNT(*) AS number_of_sales,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price
FROM sales GROUP BY product ORDER BY average_price DESC, product""")
def product_avg_price(spark, d):
    return S.product_avg_price(T.sales(spark, d, with_orders=False))


@query("segment_stats", with_(SALES, CUSTOMERS) + f"""
SELECT segment, COUNT(*) AS number_of_transactions,
       CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price,
       {ratio('SUM(age)', 'COUNT(age)')} AS average_age
FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY segment ORDER BY revenue DESC, segment""")
def segment_stats(spark, d):
    s, c = _sc(spark, d)
    return S.segment_stats(c, s)


@query("segment_age", with_(CUSTOMERS) + f"""
SELECT segment, {ratio('SUM(age)', 'COUNT(age)')} AS average_age,
       COUNT(*) AS number_of_customers
FROM customers GROUP BY segment ORDER BY segment""")
def segment_age(spark, d):
    return S.segment_age(T.customers(spark, d))


AGE_BAND_SQL = """CASE WHEN age < 30 THEN '18-29' WHEN age >= 30 AND age < 40 THEN '30-39'
                   WHEN age >= 40 AND age < 50 THEN '40-49' ELSE '50+' END"""


@query("age_bands", with_(SALES, CUSTOMERS) + f"""
SELECT {AGE_BAND_SQL} AS age_band, COUNT(*) AS number_of_transactions,
       CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price
FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY 1 ORDER BY 1""")
def age_bands(spark, d):
    s, c = _sc(spark, d)
    return S.age_band_stats(c, s)


MONTHLY_SQL = f"""
monthly AS (
  SELECT CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
         category, region, COUNT(*) AS n_transactions,
         SUM({dec('quantity')}) AS total_quantity,
         SUM({mprod('price', 'quantity')}) AS revenue
  FROM sales s JOIN customers c ON s.customer_id = c.customer_id
  GROUP BY 1, 2, category, region)"""


@query("monthly_base", with_(SALES, CUSTOMERS, MONTHLY_SQL) + """
SELECT year, month, category, region, n_transactions,
       CAST(total_quantity AS DOUBLE) AS total_quantity, CAST(revenue AS DOUBLE) AS revenue
FROM monthly""")
def monthly_base(spark, d):
    s, c = _sc(spark, d)
    return S.monthly_base(c, s)


def _kept_monthly(spark, d):
    """The monthly table built from the sales up to 1997 that are no late ones,
    then refreshed with those from 1998 on and the late ones."""
    s, c = _sc(spark, d)
    path = scratch_path(spark, "monthly")
    late = (F.year("sale_date") >= 1998) | ((F.col("order_id") % 50 == 0) & (F.month("sale_date") == 3))
    S.write_monthly(S.monthly_base(c, s.where(~late), as_double=False), path)
    S.refresh_monthly(spark, path, S.monthly_base(c, s.where(late), as_double=False))
    return S.read_monthly(spark, path)


@query("monthly_refresh", with_(SALES, CUSTOMERS, MONTHLY_SQL) + """
SELECT year, month, category, region, n_transactions,
       CAST(total_quantity AS DOUBLE) AS total_quantity, CAST(revenue AS DOUBLE) AS revenue
FROM monthly""")
def monthly_refresh(spark, d):
    """A12 as a table kept up by deltas, equal to a rebuild."""
    return S.monthly_as_double(_kept_monthly(spark, d))


@query("monthly_by_region", with_(SALES, CUSTOMERS, MONTHLY_SQL) + """
SELECT region, year, month, CAST(SUM(revenue) AS DOUBLE) AS revenue,
       CAST(SUM(total_quantity) AS DOUBLE) AS total_quantity
FROM monthly GROUP BY region, year, month ORDER BY region, year, month""")
def monthly_by_region(spark, d):
    """A13, read from the kept table."""
    return S.monthly_by_region(_kept_monthly(spark, d))


@query("top_products", with_(SALES) + f"""
SELECT product, CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue,
       {msum('quantity')} AS total_quantity
FROM sales GROUP BY product ORDER BY SUM({mprod('price', 'quantity')}) DESC, product LIMIT 5""")
def top_products(spark, d):
    return S.top_products(T.sales(spark, d, with_orders=False), k=5)


@query("segment_category_distinct", with_(SALES, CUSTOMERS) + f"""
SELECT segment, category, CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue,
       COUNT(DISTINCT s.customer_id) AS number_of_customers
FROM sales s JOIN customers c ON s.customer_id = c.customer_id
GROUP BY segment, category ORDER BY segment, revenue DESC, category""")
def segment_category_distinct(spark, d):
    s, c = _sc(spark, d)
    return S.segment_category_customers(c, s)


WEEKDAY_SQL = """CASE d WHEN 1 THEN 'Neděle' WHEN 2 THEN 'Pondělí' WHEN 3 THEN 'Úterý'
  WHEN 4 THEN 'Středa' WHEN 5 THEN 'Čtvrtek' WHEN 6 THEN 'Pátek' WHEN 7 THEN 'Sobota' END"""


@query("weekday_sales", with_(SALES) + f"""
, w AS (SELECT CAST(dayofweek(sale_date) + 1 AS INTEGER) AS d, price, quantity FROM sales)
SELECT {WEEKDAY_SQL} AS day, d AS day_number, COUNT(*) AS number_of_transactions,
       CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue
FROM w GROUP BY d ORDER BY d""")
def weekday_sales(spark, d):
    return S.weekday_stats(T.sales(spark, d))


@query("category_revenue", with_(SALES) + f"""
SELECT category, COUNT(*) AS number_of_sales,
       CAST(ROUND(SUM({mprod('price', 'quantity')}), 2) AS DOUBLE) AS revenue
FROM sales GROUP BY category ORDER BY revenue DESC, category""")
def category_revenue(spark, d):
    return S.category_revenue_rounded(T.sales(spark, d, with_orders=False))


@query("sales_by_month_text", with_(SALES) + f"""
SELECT strftime(sale_date, '%m') AS month, COUNT(*) AS number_of_sales,
       CAST(SUM({mprod('price', 'quantity')}) AS DOUBLE) AS revenue
FROM sales GROUP BY 1 ORDER BY 1""")
def sales_by_month_text(spark, d):
    return S.month_text_stats(T.sales(spark, d))


@query("month_over_month", with_(SALES) + f"""
, m AS (
  SELECT category, CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
         SUM({mprod('price', 'quantity')}) AS rev
  FROM sales GROUP BY 1, 2, 3)
, l AS (SELECT *, LAG(rev) OVER (PARTITION BY category ORDER BY year, month) AS prev FROM m)
SELECT category, year, month, CAST(rev AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS previous_revenue,
       CAST(rev - prev AS DOUBLE) AS change, {ratio('rev - prev', 'prev')} AS change_ratio
FROM l ORDER BY category, year, month""")
def month_over_month(spark, d):
    return S.month_over_month(T.sales(spark, d))


@query("customer_orders_summary", with_(CUSTOMERS) + f"""
, o AS (SELECT o_custkey AS customer_id, COUNT(*) AS total_orders,
               SUM({dec('o_totalprice')}) AS amt, MAX(o_orderdate) AS last_order_date
        FROM orders GROUP BY o_custkey)
SELECT c.customer_id, COALESCE(total_orders, 0) AS total_orders,
       CAST(amt AS DOUBLE) AS total_amount, {ratio('amt', 'total_orders')} AS avg_order_amount,
       last_order_date
FROM customers c LEFT JOIN o ON c.customer_id = o.customer_id""")
def customer_orders_summary(spark, d):
    orders = T.table(spark, d, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("order_date"))
    return S.customer_order_summary(T.customers(spark, d), orders)


@query("category_product_summary", with_(PRODUCTS) + f"""
SELECT category, COUNT(*) AS product_count,
       ROUND({ratio('SUM(' + dec('price') + ')', 'COUNT(price)')}, 2) AS average_price
FROM products GROUP BY category ORDER BY category""")
def category_product_summary(spark, d):
    return S.category_product_summary(T.products(spark, d))


@query("filtered_category_counts", with_(PRODUCTS) + """
SELECT category, COUNT(*) AS count FROM products WHERE price > 950
GROUP BY category ORDER BY category""")
def filtered_category_counts(spark, d):
    return S.filtered_group_counts(T.products(spark, d), F.col("price") > 950, "category")


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax"]
_LINE_OTHERS = ["l_returnflag", "l_linestatus", "l_shipdate"]


_TWICE = """
twice AS (SELECT * FROM customers UNION ALL SELECT * FROM customers WHERE customer_id % 10 = 0)"""


def _customers_twice(spark, d):
    """The customers with every tenth listed a second time."""
    c = T.customers(spark, d)
    return c.unionByName(c.where(F.col("customer_id") % 10 == 0))


@query("region_stats_listed_twice", with_(SALES, CUSTOMERS, _TWICE) + f"""
SELECT region, COUNT(DISTINCT customer_id) AS number_of_customers, COUNT(*) AS number_of_sales,
       {msum('total')} AS total_sales_amount,
       {ratio('SUM(' + dec('total') + ')', 'COUNT(DISTINCT customer_id)')} AS average_per_customer
FROM sales JOIN twice USING (customer_id) GROUP BY region""")
def region_stats_listed_twice(spark, d):
    """A2: a customer that is listed twice counts once."""
    return S.region_stats(_customers_twice(spark, d), T.order_sales(spark, d))


@query("segment_category_listed_twice", with_(SALES, CUSTOMERS, _TWICE) + f"""
SELECT segment, category,
       CAST(SUM({dec('price')} * {dec('quantity')}) AS DOUBLE) AS revenue,
       COUNT(DISTINCT customer_id) AS number_of_customers
FROM sales JOIN twice USING (customer_id) GROUP BY segment, category""")
def segment_category_listed_twice(spark, d):
    """The same for segments and categories."""
    return S.segment_category_customers(_customers_twice(spark, d), T.sales(spark, d))


@query("describe_columns", " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, COUNT({c}) AS count, "
     f"CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE) / CAST(NULLIF(COUNT({c}), 0) AS DOUBLE) AS mean, "
     f"ROUND(stddev_samp({c}), 6) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, "
     f"CAST(MAX({c}) AS DOUBLE) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM lineitem"
     for c in _LINE_NUMBERS]
    + [f"SELECT '{c}', COUNT({c}), NULL, NULL, NULL, NULL, MIN({c})::VARCHAR, MAX({c})::VARCHAR FROM lineitem"
       for c in _LINE_OTHERS]))
def describe_columns(spark, d):
    """describe() of every column in long form, one aggregate pass."""
    from martlake.operators.profile import describe_long
    return describe_long(T.table(spark, d, "lineitem"))


@query("approx_quartiles", """
SELECT COUNT(*) > 0 AS any_rows,
       true AS within_rank_error FROM lineitem""")
def approx_quartiles(spark, d):
    """A26 (large data): approximate quartiles, checked against the rank error
    that they promise."""
    from martlake.operators.stats import approx_quantiles
    li = T.table(spark, d, "lineitem").select("l_extendedprice")
    probs, accuracy = [0.25, 0.5, 0.75], 1000
    got = approx_quantiles(li, "l_extendedprice", probs, accuracy=accuracy).first()
    x = F.col("l_extendedprice")
    ok = F.lit(True)
    for p, v in zip(probs, got):
        ok = ok & (F.count_if(x < v) <= F.count(x) * (p + 1 / accuracy)) & (F.count_if(x <= v) >= F.count(x) * (p - 1 / accuracy))
    return li.agg((F.count(F.lit(1)) > 0).alias("any_rows"), ok.alias("within_rank_error"))


_PRODUCT_COLS = ["product_id", "product_name", "category", "price", "description", "stock", "brand"]


@query("null_profile", with_(PRODUCTS) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM products"
    for c in _PRODUCT_COLS))
def null_profile(spark, d):
    """NULL count of every column in one pass."""
    from martlake.operators.profile import null_counts
    return null_counts(T.products(spark, d))


@query("price_tiers", """
SELECT CASE WHEN value IS NULL THEN NULL WHEN value < 50 THEN 'Nízká' WHEN value < 200 THEN 'Střední'
            ELSE 'Vysoká' END AS price_tier,
       COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1 ORDER BY 1""")
def price_tiers(spark, d):
    """Price tier as a built-in CASE (no Python UDF) over event
    amounts."""
    from martlake.functions.labels import price_tier
    from martlake.functions.numeric import money_sum, to_double
    e = T.events(spark, d)
    return (e.groupBy(price_tier("value").alias("price_tier"))
            .agg(F.count(F.lit(1)).alias("n"), money_sum("value").alias("_v"))
            .select("price_tier", "n", to_double("_v").alias("total_value"))
            .orderBy("price_tier"))


TYPE_GROUPS = {"Basic": ["STANDARD", "ECONOMY"], "Promo": ["PROMO"], "Sized": ["SMALL", "MEDIUM"]}


@query("product_labels", with_(PRODUCTS) + """
SELECT product_id,
       CASE WHEN stock = 0 THEN 'out of stock' WHEN stock < 10 THEN 'low stock' ELSE 'in stock' END
         AS stock_status,
       CASE WHEN category IN ('STANDARD', 'ECONOMY') THEN 'Basic' WHEN category IN ('PROMO') THEN 'Promo'
            WHEN category IN ('SMALL', 'MEDIUM') THEN 'Sized' ELSE 'Other' END AS type_group,
       CASE WHEN brand = 'Brand#1' THEN 1 ELSE 0 END AS premium_flag
FROM products""")
def product_labels(spark, d):
    """Stock status, category from product type lists,
    0/1 flag."""
    from martlake.functions.labels import category_from_type, flag01, stock_status
    p = T.products(spark, d)
    return p.select("product_id", stock_status("stock").alias("stock_status"),
                    category_from_type("category", TYPE_GROUPS).alias("type_group"),
                    flag01(F.col("brand") == "Brand#1").alias("premium_flag"))


@query("order_value_stats", """
WITH o AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, COUNT(*) AS lines
           FROM lineitem GROUP BY l_orderkey)
SELECT COUNT(*) AS orders, CAST(SUM(v) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_order_value,
       CAST(SUM(lines) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_lines_per_order FROM o""")
def order_value_stats(spark, d):
    """Average order value and lines per order."""
    return S.order_value_stats(T.sales(spark, d, with_orders=False, with_products=False))


@query("avg_order_size_by_category", with_(SALES) + f"""
SELECT category, {ratio('SUM(' + dec('quantity') + ')', 'COUNT(quantity)')} AS avg_quantity,
       COUNT(*) AS number_of_sales
FROM sales GROUP BY category ORDER BY avg_quantity DESC, category""")
def avg_order_size_by_category(spark, d):
    """Average order size per category."""
    return S.avg_order_size_by_category(T.sales(spark, d, with_orders=False))
