"""Sink round trips: write with Spark, read back, compare with the SQL of
what was written (K1-K15, S1-S3, S5, S7-S11, S15, S17-S19)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from martlake.operators import quality as Q
from martlake.operators import sales as S
from martlake.operators import text as X
from martlake.plans import flows
from martlake.plans.registry import query
from martlake.plans.sales_queries import MONTHLY_SQL
from martlake.plans.sql_helpers import CUSTOMERS, PRODUCTS, SALES, dec, msum, quantile, ratio, with_
from martlake.session import scratch_path
from martlake.sources import files as FS
from martlake.sources import sinks as K
from martlake.sources import tables as T

RUN_TS = "2025-01-31 23:59:59"


def _table_name(prefix: str, path: str) -> str:
    return prefix + "_" + path.rstrip("/").rsplit("-", 1)[-1]


@query("roundtrip_parquet", with_(SALES, CUSTOMERS, MONTHLY_SQL) + """
SELECT month, category, region, n_transactions, CAST(total_quantity AS DOUBLE) AS total_quantity,
       CAST(revenue AS DOUBLE) AS revenue, year FROM monthly""")
def roundtrip_parquet(spark, d):
    """Parquet (snappy) partitioned by year."""
    base = S.monthly_base(T.customers(spark, d), T.sales(spark, d))
    p = scratch_path(spark, "rt-parquet")
    K.write_parquet(base, p, partition_by=["year"])
    return spark.read.parquet(p)


_CAT_SQL = with_(SALES) + f"""
SELECT category, COUNT(*) AS number_of_sales, {msum('total')} AS total_sales_amount,
       {ratio('SUM(' + dec('price') + ')', 'COUNT(price)')} AS average_price,
       {msum('quantity')} AS total_quantity,
       CAST(SUM(CAST(price AS DECIMAL(18,2)) * CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM sales GROUP BY category"""

_CAT_SCHEMA = ("category string, number_of_sales bigint, total_sales_amount double, "
               "average_price double, total_quantity double, revenue double")


@query("roundtrip_csv", _CAT_SQL)
def roundtrip_csv(spark, d):
    """CSV with header, read back with an explicit schema."""
    p = scratch_path(spark, "rt-csv")
    K.write_csv(S.category_stats(T.sales(spark, d)), p, header=True)
    return FS.read_csv(spark, p, _CAT_SCHEMA)


@query("roundtrip_csv_single", _CAT_SQL)
def roundtrip_csv_single(spark, d):
    """K4 / K5 / S3: a small report as one headerless file, read back and
    renamed."""
    p = scratch_path(spark, "rt-csv1")
    K.write_single_csv(S.category_stats(T.sales(spark, d)), p, header=False)
    names = [c.split()[0] for c in _CAT_SCHEMA.split(", ")]
    return FS.read_csv(spark, p, _CAT_SCHEMA, header=False).toDF(*names)


@query("roundtrip_orc_ctas", with_(SALES, CUSTOMERS, MONTHLY_SQL) + """
SELECT year, month, category, region, n_transactions, CAST(total_quantity AS DOUBLE) AS total_quantity,
       CAST(revenue AS DOUBLE) AS revenue FROM monthly""")
def roundtrip_orc_ctas(spark, d):
    """CTAS into an ORC table from a temp view."""
    base = S.monthly_base(T.customers(spark, d), T.sales(spark, d))
    loc = scratch_path(spark, "rt-orc")
    view, table = _table_name("v_monthly", loc), _table_name("t_monthly", loc)
    FS.register_temp_view(base, view)
    K.create_table_as(spark, table, f"SELECT * FROM {view}", "orc", loc)
    return spark.table(table)


@query("roundtrip_catalog", with_(PRODUCTS) + "SELECT * FROM products WHERE price > 950")
def roundtrip_catalog(spark, d):
    """saveAsTable, then INSERT OVERWRITE ... SELECT."""
    p = T.products(spark, d)
    loc = scratch_path(spark, "rt-table")
    table, view = _table_name("t_products", loc), _table_name("v_products", loc)
    K.save_table(p, table, path=loc)
    FS.register_temp_view(p.where(F.col("price") > 950), view)
    K.insert_overwrite(spark, table, f"SELECT * FROM {view}")
    return spark.table(table)


@query("roundtrip_text", r"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def roundtrip_text(spark, d):
    """Word counts as ``word<TAB>count`` text lines, read back."""
    counts = X.word_counts(T.documents(spark, d), "text", "ws")
    p = scratch_path(spark, "rt-text")
    K.write_text_pairs(counts, p, "word", "count")
    lines = FS.read_text_lines(spark, p)
    parts = F.split(F.col("value"), "\t")
    return lines.select(parts[0].alias("word"), parts[1].cast("bigint").alias("count"))


@query("run_stamped_results", with_(SALES) + f"""
SELECT payment_method, COUNT(*) AS number_of_sales, {msum('total')} AS total_amount,
       {ratio('SUM(' + dec('total') + ')', 'COUNT(total)')} AS average_amount,
       '20250131_235959' AS analysis_date
FROM sales GROUP BY payment_method""")
def run_stamped_results(spark, d):
    """Results under ``<root>/<run stamp>/<name>`` with the audit
    column ``analysis_date``."""
    root = scratch_path(spark, "rt-runs")
    paths = K.save_results({"payment_analysis": S.payment_stats(T.sales(spark, d))}, root, RUN_TS)
    return spark.read.parquet(paths["payment_analysis"])


@query("sensor_json", """
WITH s AS (SELECT ts, user_id, value / 10.0 AS temperature,
                  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity FROM events)
SELECT ts AS timestamp, 'events' AS source, temperature, humidity, CAST(1013.0 AS DOUBLE) AS pressure,
       CAST(user_id AS VARCHAR) AS device_id, 'site-' || CAST(user_id % 5 AS VARCHAR) AS location,
       CASE WHEN temperature > 30 THEN 'high temperature' WHEN humidity > 70 THEN 'high humidity'
            ELSE 'normal' END AS condition
FROM s""")
def sensor_json(spark, d):
    """Nested sensor JSON written from events, read back with a
    nested schema, flattened and classified."""
    from martlake.functions.labels import sensor_condition
    e = T.events(spark, d)
    doc = e.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit("events").alias("source"),
        F.struct((F.col("value") / F.lit(10.0)).alias("temperature"),
                 F.get_json_object("props", "$.k").cast("double").alias("humidity"),
                 F.lit(1013.0).alias("pressure")).alias("readings"),
        F.struct(F.col("user_id").cast("string").alias("device_id"),
                 F.concat(F.lit("site-"), (F.col("user_id") % 5).cast("string")).alias("location"),
                 F.lit(False).alias("debug_mode")).alias("metadata"))
    p = scratch_path(spark, "rt-json")
    doc.write.mode("overwrite").json(p)
    flat = FS.flatten_sensor(FS.read_nested_json(spark, p, FS.SENSOR_SCHEMA))
    return flat.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "source",
                       "temperature", "humidity", "pressure", "device_id", "location",
                       sensor_condition("temperature", "humidity").alias("condition"))


@query("config_driven_load", with_(PRODUCTS) + """
, dd AS (SELECT DISTINCT * FROM products)
, med AS (SELECT """ + quantile("dd", "price", 0.5) + """ AS m)
, md AS (SELECT category AS m FROM dd WHERE category IS NOT NULL
         GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 1)
SELECT product_id, product_name, COALESCE(category, (SELECT m FROM md)) AS category,
       COALESCE(CAST(price AS DOUBLE), (SELECT m FROM med)) AS price,
       COALESCE(description, '') AS description, stock, brand
FROM dd""")
def config_driven_load(spark, d):
    """A config row picks format (parquet), transform (basic) and
    target table."""
    src = scratch_path(spark, "rt-config-src")
    T.products(spark, d).write.mode("overwrite").parquet(src)
    tgt = scratch_path(spark, "rt-config-tgt")
    cfg = {"source_type": "parquet", "source_path": src, "transform_type": "basic",
           "target_table": _table_name("t_config", tgt), "target_path": tgt}
    return flows.run_config(spark, cfg)


#: Columns of the given tables, for the oracle: plain ones, and those that are
#: doubles (d), times (t) or lists of floats (l).
_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal:d c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal:d",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:d",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:d o_orderdate:t o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:d l_extendedprice:d l_discount:d l_tax:d l_returnflag"
                " l_linestatus l_shipdate:t",
    "events": "event_id ts:t user_id event_type value:d props", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding:l label", "pages": "page_id url html", "benchmark": "item_id text",
    "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}


def _profile_sql(table: str) -> str:
    def text(column: str) -> str:
        name, _, kind = column.partition(":")
        double = "replace(printf('%a', {}::DOUBLE), 'p+', 'p')"
        value = {"d": double.format(name), "t": f"epoch_us({name})::VARCHAR", "": f"{name}::VARCHAR",
                 "l": f"'[' || array_to_string(list_transform({name}, lambda e: coalesce({double.format('e')}, 'null')), ',') || ']'"}[kind]
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE length({value}) || ':' || {value} END"
    row = " || ".join(map(text, _COLUMNS[table].split()))
    return (f"SELECT '{table}' AS name, COUNT(*) AS rows,"
            f" CAST(coalesce(SUM(CAST('0x' || substr(sha256({row}), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS checksum FROM {table}")


@query("input_profile", " UNION ALL ".join(map(_profile_sql, _COLUMNS)))
def input_profile(spark, d):
    """Rows and content checksum of each input table."""
    profiles = [FS.table_profile(T.table(spark, d, t)).select(F.lit(t).alias("name"), "rows", "checksum") for t in _COLUMNS]
    return reduce(lambda a, b: a.unionByName(b), profiles)


_ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@query("external_csv_table", "SELECT * FROM orders")
def external_csv_table(spark, d):
    """Orders exported as CSV with a header line, then read
    through an external delimited-text table declared with DDL."""
    loc = scratch_path(spark, "rt-ext-csv")
    K.write_csv(T.table(spark, d, "orders"), loc, header=True)
    db = _table_name("martlake_rt", loc)
    K.create_database(spark, db, scratch_path(spark, "rt-db"))
    table = f"{db}.{_table_name('orders_csv', loc)}"
    K.create_external_csv_table(spark, table, _ORDERS_DDL, loc, header=True)
    return spark.table(table)


@query("csv_inferred", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_type, p_retailprice FROM part""")
def csv_inferred(spark, d):
    """CSV with a header line, types inferred."""
    p = scratch_path(spark, "rt-inferred")
    K.write_csv(T.table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_retailprice"), p)
    return FS.read_csv_inferred(spark, p)


@query("csv_headerless", """
SELECT CAST(p_partkey AS INTEGER) AS id, p_type AS kind, p_retailprice AS price FROM part""")
def csv_headerless(spark, d):
    """S3: CSV without a header, columns named by the caller."""
    p = scratch_path(spark, "rt-headerless")
    K.write_csv(T.table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice"), p, header=False)
    return FS.read_csv_headerless(spark, p, ["id", "kind", "price"])


@query("csv_malformed", """
SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_retailprice END AS price,
       p_partkey % 10 = 0 AS malformed FROM part""")
def csv_malformed(spark, d):
    """Malformed rows are kept and marked."""
    root = scratch_path(spark, "rt-malformed")
    price = F.when(F.col("p_partkey") % 10 == 0, F.lit("abc")).otherwise(F.col("p_retailprice").cast("string"))
    K.write_csv(T.table(spark, d, "part").select("p_partkey", price.alias("price")), f"{root}/part.csv")
    df = FS.extract_csv(spark, root, "part.csv", "p_partkey bigint, price double")
    return df.select("p_partkey", "price", F.col("_corrupt_record").isNotNull().alias("malformed"))


@query("dead_letter_batches", with_(PRODUCTS) + """
SELECT CAST(product_id % 2 AS INTEGER) AS batch,
       concat_ws(',', CASE WHEN price < 905 THEN 'low_price' END, CASE WHEN price IS NULL THEN 'missing_price' END)
         AS failed_rules, COUNT(*) AS rows
FROM products WHERE price < 905 OR price IS NULL GROUP BY 1, 2""")
def dead_letter_batches(spark, d):
    """Two batches routed to one error area, the first of them twice."""
    rules = [("low_price", F.col("price") < 905), ("missing_price", F.col("price").isNull())]
    p, area = T.products(spark, d), scratch_path(spark, "rt-errors")
    for batch in (0, 1, 0):
        Q.route_dead_letter(p.where(F.col("product_id") % 2 == batch), rules, area, str(batch))
    return (spark.read.parquet(area).groupBy("batch", "failed_rules").agg(F.count(F.lit(1)).alias("rows")))


@query("load_verified", with_(PRODUCTS) + """
SELECT COUNT(*) AS rows, true AS verified, false AS verified_short FROM products""")
def load_verified(spark, d):
    """Row count of a loaded table against the rows written."""
    p, loc = T.products(spark, d), scratch_path(spark, "rt-verify")
    table = _table_name("t_verify", loc)
    out, rows = Q.observed(p, "verify")
    K.save_table(out, table, path=loc)
    n = rows.get["rows"]
    ok, short = K.verify_load(spark, table, n), K.verify_load(spark, table, n + 1)
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(ok).alias("verified"), F.lit(short).alias("verified_short"))


@query("required_columns", with_(PRODUCTS) + """
SELECT 'price' AS column_name, true AS present, COUNT(price) AS filled FROM products
UNION ALL SELECT 'category', true, COUNT(category) FROM products
UNION ALL SELECT 'supplier', false, NULL FROM products LIMIT 3""")
def required_columns(spark, d):
    """Required columns by the schema, with their filled rows."""
    p = T.products(spark, d)
    required = ["price", "category", "supplier"]
    missing = set(Q.required_columns_missing(p, required))
    counts = p.agg(*[F.count(c).alias(c) for c in required if c not in missing])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(c not in missing).alias("present"),
        (F.lit(None).cast("bigint") if c in missing else F.col(c)).alias("filled")) for c in required])))


@query("booleans_loaded", with_(PRODUCTS) + """
, med AS (SELECT """ + quantile("products", "price", 0.5) + """ AS m)
SELECT product_id, CAST(COALESCE(price > m, false) AS DOUBLE) AS is_expensive FROM products, med""")
def booleans_loaded(spark, d):
    """A boolean feature as a number in the loaded table."""
    from martlake.operators import features as X2
    f = X2.generate_features(T.products(spark, d).select("product_id", "price"))
    loc = scratch_path(spark, "rt-bool")
    K.save_table(X2.booleans_to_double(f).select("product_id", "is_expensive"), _table_name("t_bool", loc), path=loc)
    return spark.table(_table_name("t_bool", loc))


@query("audit_counts", with_(PRODUCTS) + """
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE price > 950) AS rows_after FROM products""")
def audit_counts(spark, d):
    """Q10: rows before and after a filter, counted by the write itself."""
    loc = scratch_path(spark, "rt-audit")
    before, n_before = Q.observed(T.products(spark, d), "before")
    after, n_after = Q.observed(before.where(F.col("price") > 950), "after")
    K.write_parquet(after, loc)
    return spark.read.parquet(loc).agg(F.lit(n_before.get["rows"]).cast("bigint").alias("rows_before"),
                                       F.max(F.lit(n_after.get["rows"])).cast("bigint").alias("rows_after"))


@query("text_profile", """
SELECT COUNT(*) AS lines, SUM(length(line))::BIGINT AS chars,
       CAST(SUM(CAST(('0x' || substr(sha256(line), 1, 15))::BIGINT AS HUGEINT)) AS VARCHAR) AS checksum
FROM (SELECT o_orderkey || '|' || o_custkey AS line FROM orders)""")
def text_profile(spark, d):
    """Line count, size and checksum of text files of any size."""
    p = scratch_path(spark, "rt-profile")
    o = T.table(spark, d, "orders")
    o.select(F.concat_ws("|", "o_orderkey", "o_custkey").alias("value")).write.text(p)
    return FS.text_profile(spark, p, by_file=False)


@query("bucketed_time_stats", with_(SALES) + f"""
SELECT CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
       COUNT(*) AS number_of_sales, {msum('total')} AS total_sales_amount,
       {ratio('SUM(' + dec('total') + ')', 'COUNT(total)')} AS average_sale_value
FROM sales GROUP BY 1, 2 ORDER BY 1, 2""")
def bucketed_time_stats(spark, d):
    """A4 over tables bucketed by order key: their join needs no shuffle."""
    from martlake.sources import layout as L
    root = scratch_path(spark, "rt-bucketed")
    li, od = L.bucket_sales_inputs(spark, d, root, 8, prefix=_table_name("bk", root))
    return S.time_stats(L.sales_from_bucketed(spark, d, li, od))
