"""Driver tables and the role frames the analytics run on.

The reference's roles (sale, customer, product, event, text line) are bound
to the driver's TPC-H-like tables here, once, as lazy DataFrames. Catalyst
prunes the columns each query does not touch and pushes filters into the
Parquet scans.

Role mapping
------------
sale      lineitem ⋈ orders ⋈ part: quantity = l_quantity,
          total = l_extendedprice, price = p_retailprice,
          category = p_type, product = p_name, customer = o_custkey,
          sale_date = o_orderdate, payment_method = o_orderpriority
customer  customer ⋈ nation ⋈ region: country = n_name, region = r_name,
          segment = c_mktsegment, age = 18 + c_custkey % 60
product   part with deterministic NULLs / empty strings / extreme prices,
          for the cleaning, feature, currency and quality operators
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.numeric import money_sum

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read the same way at every size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Temp views over the driver tables (S11), so the SQL text of a query
    runs unchanged against Spark."""
    for n in names or TABLE_NAMES:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: 25 rows at every scale. No hint: Spark's size
    estimate of the files (``autoBroadcastJoinThreshold``) broadcasts them,
    so the broadcast stays behind a size check."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey"), F.col("n_name").alias("country"),
                    F.col("r_name").alias("region")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, name, segment, country, region, age, acctbal."""
    c = table(spark, sf_dir, "customer")
    geo = geography(spark, sf_dir)
    return (c.join(geo, c.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("segment"),
                    "country", "region",
                    (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
                    F.col("c_acctbal").alias("acctbal")))


def sales(spark: SparkSession, sf_dir: str, with_orders: bool = True,
          with_products: bool = True) -> DataFrame:
    """One row per line item with its order and product attributes.

    Both joins are equi-joins on the dimension's unique key; Spark sizes
    them at plan time (broadcast below ``autoBroadcastJoinThreshold``) and
    AQE re-plans at run time, splitting skewed join partitions.

    Every line has its order and its part (foreign keys; checked by the
    ``orphan_rows`` report), so a report that needs no order (or product)
    column leaves that join out — an inner join on a foreign key cannot
    change the rows. At scale that saves a shuffle join of the fact table.
    """
    l = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("total"))
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("sale_date"),
        F.col("o_orderpriority").alias("payment_method"))
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))
    out = l
    if with_products:
        out = out.join(p, "product_id")
    if with_orders:
        out = out.join(o, "order_id")
    return out


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its sale-row count ``_lines``, exact total and
    quantity, with the order attributes.

    For reports that need no product column. The lines are summed per
    order first (partial aggregation combines the lines of an order where
    they sit together in the files), so the join with ``orders`` sees one
    row per order instead of one per line; the aggregate's output is already
    partitioned by order key, so only ``orders`` is shuffled for the join.
    """
    l = (table(spark, sf_dir, "lineitem")
         .groupBy(F.col("l_orderkey").alias("order_id"))
         .agg(F.count(F.lit(1)).alias("_lines"),
              money_sum("l_extendedprice").alias("total"), money_sum("l_quantity").alias("quantity")))
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("sale_date"),
        F.col("o_orderpriority").alias("payment_method"))
    return l.join(o, "order_id")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product table of the cleaning and feature operators, derived from
    ``part`` with deterministic gaps (the driver tables hold no NULLs)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("product_id"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("product_name"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(""))
         .otherwise(F.col("p_type")).alias("category"),
        F.when(k % 7 == 0, F.lit(None).cast("double"))
         .when(k % 101 == 0, F.col("p_retailprice") * 10)
         .otherwise(F.col("p_retailprice")).alias("price"),
        F.when(k % 5 == 0, F.lit(None))
         .otherwise(F.concat_ws(" ", F.col("p_name"), F.col("p_brand"))).alias("description"),
        F.col("p_size").alias("stock"),
        F.col("p_brand").alias("brand"),
    )


# The same derivation as SQL, for the DuckDB oracle strings.
PRODUCTS_SQL = """
products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END AS product_name,
         CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN ''
              ELSE p_type END AS category,
         CASE WHEN p_partkey % 7 = 0 THEN NULL
              WHEN p_partkey % 101 = 0 THEN p_retailprice * 10
              ELSE p_retailprice END AS price,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat_ws(' ', p_name, p_brand) END AS description,
         p_size AS stock,
         p_brand AS brand
  FROM part)"""

SALES_SQL = """
sales AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
         l_extendedprice AS total, p_name AS product, p_type AS category,
         p_retailprice AS price, o_custkey AS customer_id, o_orderdate AS sale_date,
         o_orderpriority AS payment_method
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

CUSTOMERS_SQL = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
         n_name AS country, r_name AS region, CAST(18 + c_custkey % 60 AS INTEGER) AS age,
         c_acctbal AS acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")
