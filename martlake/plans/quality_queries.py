"""Currency and data-quality queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from martlake.operators import currency as CUR
from martlake.operators import quality as Q
from martlake.operators import rules as R
from martlake.plans.registry import query
from martlake.plans.sql_helpers import CUSTOMERS, PRODUCTS, with_
from martlake.sources import tables as T

# Rate document of the examples (base EUR). USD and CZK are the reference's
# sample rates; GBP and JPY complete its target list.
RATES_DOC = json.dumps({"base": "EUR", "rates": {"USD": 1.1, "CZK": 25.5, "GBP": 0.85, "JPY": 160.25}})
TARGETS = ["USD", "CZK", "GBP", "JPY"]
RATES_DATE = "2025-01-01"
# Categories accepted by the strict level on the driver tables' product types.
ALLOWED_CATEGORIES = ["STANDARD", "ECONOMY", "PROMO", "MEDIUM", "SMALL"]
RATES_SQL = "rates(currency, rate) AS (VALUES ('USD', 1.1), ('CZK', 25.5), ('GBP', 0.85), ('JPY', 160.25))"


def _rates(spark):
    docs = spark.createDataFrame([(RATES_DOC,)], "value string")
    return CUR.rates_from_documents(docs)


def _conv_sql(price: str, code: str) -> str:
    # The product is rounded, never its factors.
    return (f"CAST(ROUND(CAST({price} AS DECIMAL(21,8)) * CAST((SELECT rate FROM rates "
            f"WHERE currency = '{code}') AS DECIMAL(16,8)), 2) AS DOUBLE) AS {price}_{code}")


# Prices with more than two decimals: a factor that is rounded first shows.
FINE_SQL = """fine AS (SELECT product_id, price / 7 + product_id / 1000.0 AS price FROM products)"""


@query("currency_fine_prices", with_(PRODUCTS, RATES_SQL, FINE_SQL) + f"""
SELECT product_id, CAST(price AS DOUBLE) AS price, 'EUR' AS price_currency,
       {', '.join(_conv_sql('price', c) for c in TARGETS)} FROM fine""")
def currency_fine_prices(spark, d):
    """C11: prices with many decimals; only the converted price is rounded."""
    p = T.products(spark, d).select(
        "product_id", (F.col("price") / 7 + F.col("product_id") / F.lit(1000.0)).alias("price"))
    return CUR.enrich_with_currency(p, _rates(spark), "price", TARGETS, "EUR")


_META_CODES = "'" + str(["CZK", "GBP", "JPY", "USD", "EUR"]).replace("'", "''") + "'"
_PCOLS = "product_id, product_name, category, CAST(price AS DOUBLE) AS price, description, stock, brand"


@query("currency_strict", with_(PRODUCTS, RATES_SQL) + f"""
SELECT {_PCOLS}, 'EUR' AS price_currency, {', '.join(_conv_sql('price', c) for c in TARGETS)},
       {_META_CODES} AS available_currencies,
       'EUR' AS base_currency, '{RATES_DATE}' AS currency_rates_date
FROM products""")
def currency_strict(spark, d):
    """C8 + C10: strict enrichment with metadata."""
    return CUR.transform(T.products(spark, d), _rates(spark), "price", TARGETS, "EUR",
                         strict=True, rates_date=RATES_DATE)


SMALL_RATES = {"IRR": 0.0000392123, "TNY": 0.000000001234, "BIG": 123456.789}


@query("currency_small_rates", "SELECT o_orderkey, o_totalprice, 'EUR' AS o_totalprice_currency, " + ", ".join(
    f"CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,6)) * CAST('{rate:.12f}' AS DECIMAL(20,12)), 2) AS DOUBLE) AS o_totalprice_{code}"
    for code, rate in sorted(SMALL_RATES.items())) + " FROM orders")
def currency_small_rates(spark, d):
    """Rates of many decimals and large ones."""
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return CUR.enrich_with_currency(orders, CUR.rates_frame(spark, SMALL_RATES), "o_totalprice", sorted(SMALL_RATES))


@query("currency_tolerant", with_(PRODUCTS, RATES_SQL) + f"""
SELECT {_PCOLS}, 'EUR' AS price_currency, {_conv_sql('price', 'USD')}, {_conv_sql('price', 'CZK')}
FROM products""")
def currency_tolerant(spark, d):
    """An unknown target (XXX) and the base (EUR) are dropped."""
    return CUR.transform(T.products(spark, d), _rates(spark), "price", ["USD", "XXX", "CZK", "EUR"],
                         "EUR", strict=False, add_currency_metadata=False)


@query("currency_base_only", with_(PRODUCTS) + f"""
SELECT {_PCOLS}, 'EUR' AS price_currency FROM products""")
def currency_base_only(spark, d):
    """No requested currency is available -> base currency only."""
    return CUR.transform(T.products(spark, d), _rates(spark), "price", ["XXX", "YYY"],
                         "EUR", strict=False, add_currency_metadata=False)


@query("currency_meta", with_(PRODUCTS) + f"""
SELECT product_id, {_META_CODES} AS available_currencies,
       'EUR' AS base_currency, '{RATES_DATE}' AS currency_rates_date FROM products""")
def currency_meta(spark, d):
    """Currency metadata columns."""
    p = T.products(spark, d).select("product_id")
    return CUR.add_currency_info(p, _rates(spark), "EUR", RATES_DATE)


@query("quality_basic", with_(PRODUCTS) + """
SELECT 'negative_price' AS rule, COUNT(*) FILTER (WHERE price < 0) AS failures FROM products
UNION ALL
SELECT 'empty_category', COUNT(*) FILTER (WHERE category IS NULL OR category = '') FROM products""")
def quality_basic(spark, d):
    """Q1 / Q3 basic level: report only, never stops."""
    return Q.validate(T.products(spark, d), "basic")


_ALLOWED_SQL = ", ".join(f"'{c}'" for c in ALLOWED_CATEGORIES)


@query("quality_strict", with_(PRODUCTS) + f"""
SELECT 'suspicious_price' AS rule, COUNT(*) FILTER (WHERE price <= 0 OR price > 10000) AS failures FROM products
UNION ALL
SELECT 'short_or_missing_name', COUNT(*) FILTER (WHERE product_name IS NULL OR length(product_name) < 3) FROM products
UNION ALL
SELECT 'invalid_category', COUNT(*) FILTER (WHERE NOT COALESCE(category IN ({_ALLOWED_SQL}), false)) FROM products""")
def quality_strict(spark, d):
    """Q2 / Q3 strict level: the report; :func:`enforce` raises on it."""
    return Q.validate(T.products(spark, d), "strict", ALLOWED_CATEGORIES)


RULES_CONFIG = [
    {"name": "price_present", "column": "price", "check": "not_null"},
    {"name": "price_min", "column": "price", "check": "min", "value": 905},
    {"name": "price_max", "column": "price", "check": "max", "value": 995},
    {"name": "known_type", "column": "category", "check": "in_set", "values": ALLOWED_CATEGORIES},
    {"name": "name_length", "column": "product_name", "check": "min_length", "value": 9},
    {"name": "brand_format", "column": "brand", "check": "regex", "pattern": "^Brand#[0-9]$"},
]


@query("quality_rules", with_(PRODUCTS) + f"""
SELECT 'price_present' AS rule, COUNT(*) FILTER (WHERE price IS NULL) AS failures FROM products
UNION ALL SELECT 'price_min', COUNT(*) FILTER (WHERE price < 905) FROM products
UNION ALL SELECT 'price_max', COUNT(*) FILTER (WHERE price > 995) FROM products
UNION ALL SELECT 'known_type', COUNT(*) FILTER (WHERE NOT COALESCE(category IN ({_ALLOWED_SQL}), false)) FROM products
UNION ALL SELECT 'name_length', COUNT(*) FILTER (WHERE product_name IS NULL OR length(product_name) < 9) FROM products
UNION ALL SELECT 'brand_format', COUNT(*) FILTER (WHERE NOT COALESCE(regexp_matches(brand, '^Brand#[0-9]$'), false)) FROM products""")
def quality_rules(spark, d):
    """Q7: a rules file (list of dicts) turned into one aggregate."""
    return Q.config_report(T.products(spark, d), RULES_CONFIG)


# Rules of the line items: nested conditions, two columns of a row, and rows
# against other rows and other tables.
RULE_TREES = [
    {"name": "tax_within_discount", "check": "compare", "left": "l_tax", "op": "<=", "right": "l_discount"},
    {"name": "line_once", "check": "unique", "columns": ["l_orderkey", "l_linenumber"]},
    {"name": "cheap_part_known", "check": "foreign_key", "columns": ["l_partkey"], "references": "cheap_parts", "keys": ["p_partkey"]},
    {"name": "large_or_reduced", "any": [{"column": "l_quantity", "check": "min", "value": 10},
                                         {"not": {"column": "l_discount", "check": "max", "value": 0.05}}]},
    {"name": "returned_or_once_and_known", "any": [
        {"column": "l_returnflag", "check": "in_set", "values": ["R"]},
        {"all": [{"check": "unique", "columns": ["l_orderkey", "l_linenumber"]},
                 {"check": "foreign_key", "columns": ["l_partkey"], "references": "cheap_parts", "keys": ["p_partkey"]},
                 {"not": {"check": "unique", "columns": ["l_suppkey", "l_shipdate"]}}]}]},
]


@query("quality_rule_tree", """
WITH f AS (SELECT COALESCE(l_tax <= l_discount, true) AS tax_ok,
                  COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 OR l_orderkey IS NULL OR l_linenumber IS NULL AS once,
                  l_partkey IS NULL OR l_partkey IN (SELECT p_partkey FROM part WHERE p_retailprice < 950 AND p_partkey IS NOT NULL) AS known,
                  COALESCE(l_quantity >= 10, true) OR COALESCE(l_discount > 0.05, false) AS large,
                  COALESCE(l_returnflag = 'R', false) AS returned,
                  COUNT(*) OVER (PARTITION BY l_suppkey, l_shipdate) = 1 OR l_suppkey IS NULL OR l_shipdate IS NULL AS alone
           FROM lineitem)
SELECT 'tax_within_discount' AS rule, COUNT(*) FILTER (WHERE NOT tax_ok) AS failures FROM f
UNION ALL SELECT 'line_once', COUNT(*) FILTER (WHERE NOT once) FROM f
UNION ALL SELECT 'cheap_part_known', COUNT(*) FILTER (WHERE NOT known) FROM f
UNION ALL SELECT 'large_or_reduced', COUNT(*) FILTER (WHERE NOT large) FROM f
UNION ALL SELECT 'returned_or_once_and_known', COUNT(*) FILTER (WHERE NOT (returned OR (once AND known AND NOT alone))) FROM f""")
def quality_rule_tree(spark, d):
    """Q7: nested rules, uniqueness and a foreign key in one report."""
    cheap = T.table(spark, d, "part").where("p_retailprice < 950").select("p_partkey")
    return R.tree_report(T.table(spark, d, "lineitem"), RULE_TREES, {"cheap_parts": cheap})


@query("dead_letter", with_(PRODUCTS) + f"""
, r AS (SELECT *, concat_ws(',',
          CASE WHEN price <= 0 OR price > 10000 THEN 'suspicious_price' END,
          CASE WHEN product_name IS NULL OR length(product_name) < 3 THEN 'short_or_missing_name' END,
          CASE WHEN NOT COALESCE(category IN ({_ALLOWED_SQL}), false) THEN 'invalid_category' END) AS failed_rules
        FROM products)
SELECT * FROM r WHERE failed_rules <> ''""")
def dead_letter(spark, d):
    """Q6: invalid rows with the names of the rules they fail."""
    return Q.dead_letter(T.products(spark, d), Q.strict_rules(ALLOWED_CATEGORIES))


@query("valid_rows", with_(PRODUCTS) + """
SELECT * FROM products WHERE COALESCE(product_id > 0 AND price IS NOT NULL, false)""")
def valid_rows(spark, d):
    """The valid side of a valid/invalid split."""
    ok, _ = Q.split_valid(T.products(spark, d), Q.record_is_valid("product_id", "price"))
    return ok


@query("invalid_rows", with_(PRODUCTS) + """
SELECT * FROM products WHERE NOT COALESCE(product_id > 0 AND price IS NOT NULL, false)""")
def invalid_rows(spark, d):
    """The complement (NULL predicate counts as invalid)."""
    _, bad = Q.split_valid(T.products(spark, d), Q.record_is_valid("product_id", "price"))
    return bad


@query("min_rows_check", with_(PRODUCTS) + """
SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE product_id IS NULL) AS null_product_id,
       COUNT(*) FILTER (WHERE price IS NULL) AS null_price,
       COUNT(*) >= 1 AND COUNT(*) FILTER (WHERE product_id IS NULL) = 0
         AND COUNT(*) FILTER (WHERE price IS NULL) = 0 AS passed
FROM products""")
def min_rows_check(spark, d):
    """Q4: minimum rows and NULL keys."""
    return Q.validate_df(T.products(spark, d), 1, ["product_id", "price"])


@query("pii_hashed", with_(CUSTOMERS) + """
SELECT customer_id, country, region, age, acctbal,
       sha256(lower(replace(name, '#', '.')) || '@example.com') AS hashed_email,
       sha256(name || segment) AS hashed_name
FROM (SELECT * FROM customers)""")
def pii_hashed(spark, d):
    """Q9: e-mail and two name columns (the segment plays the last name)
    replaced by SHA-256 hashes."""
    c = T.customers(spark, d).withColumn(
        "email", F.concat(F.lower(F.replace(F.col("name"), F.lit("#"), F.lit("."))), F.lit("@example.com")))
    return Q.anonymize_pii(c, "email", ["name", "segment"])


@query("run_report", with_(PRODUCTS) + f"""
, dd AS (SELECT DISTINCT * FROM products)
, md AS (SELECT category AS m FROM dd WHERE category IS NOT NULL
         GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 1)
, mn AS (SELECT CAST(SUM(CAST(price AS DECIMAL(38,10))) AS DOUBLE) / COUNT(price) AS m FROM dd)
, c AS (SELECT COALESCE(category, (SELECT m FROM md)) AS category, COALESCE(price, (SELECT m FROM mn)) AS price FROM dd)
, e AS (SELECT COUNT(*) FILTER (WHERE price < 0) AS negative, COUNT(*) FILTER (WHERE category IS NULL OR category = '') AS empty FROM c)
SELECT (SELECT COUNT(*) FROM products) AS input_rows, 'EUR' AS base_currency, 'USD,CZK,GBP,JPY' AS target_currencies,
       CAST(4 AS INTEGER) AS currencies, (SELECT COUNT(*) FROM c) AS output_rows,
       CAST((negative > 0)::INTEGER + (empty > 0)::INTEGER AS INTEGER) AS error_count,
       array_to_string(list_filter([CASE WHEN negative > 0 THEN 'negative_price: ' || negative || ' rows' END,
                                    CASE WHEN empty > 0 THEN 'empty_category: ' || empty || ' rows' END],
                                   lambda x: x IS NOT NULL), '; ') AS errors,
       CASE WHEN negative > 0 OR empty > 0 THEN 'WARNING' ELSE 'OK' END AS status FROM e""")
def run_report(spark, d):
    """Q8: the one-row report of a currency run over the products; errors are
    the messages of the basic level, rows in are counted before cleaning."""
    from martlake.plans import flows
    from martlake.session import scratch_path
    source = scratch_path(spark, "report-in")
    T.products(spark, d).write.parquet(source)
    report = flows.run_currency_etl(spark.read.parquet(source), _rates(spark), scratch_path(spark, "report-out"),
                                    "basic", TARGETS, rates_date=RATES_DATE, input_path=source)
    return report.select("input_rows", "base_currency", "target_currencies", "currencies", "output_rows",
                         "error_count", "errors", "status")
