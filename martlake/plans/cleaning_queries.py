"""Cleaning and feature queries over the derived product table (P4, U1, W2,
C1-C7, J6, J7, W1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import cleaning as C
from martlake.operators import features as X
from martlake.plans.registry import query
from martlake.plans.sql_helpers import PRODUCTS, quantile, with_
from martlake.sources import tables as T

PRODUCT_COLS = ["product_id", "product_name", "category", "price", "description", "stock", "brand"]
MESSY = [" Product ID", "Product Name ", "CATEGORY", " Price", "Description", "Stock ", "BRAND"]


def _products(spark, d):
    return T.products(spark, d)


@query("clean_columns", with_(PRODUCTS) + "SELECT * FROM products")
def clean_columns(spark, d):
    return C.clean_column_names(_products(spark, d).toDF(*MESSY))


@query("distinct_rows", with_(PRODUCTS) + "SELECT DISTINCT product_name, category FROM products")
def distinct_rows(spark, d):
    return C.drop_duplicates(_products(spark, d).select("product_name", "category"))


@query("keep_first", with_(PRODUCTS) + """
SELECT product_id, product_name, category, price, description, stock, brand FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_name, category ORDER BY product_id) AS rn
  FROM products) WHERE rn = 1""")
def keep_first(spark, d):
    return C.keep_first(_products(spark, d), ["product_name", "category"], "product_id")


MEAN_SQL = "(CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS DOUBLE) / CAST(NULLIF(COUNT({x}), 0) AS DOUBLE))"


def _mean(x: str) -> str:
    return MEAN_SQL.format(x=x)


FILL_STRATEGY = {"product_name": "drop", "price": "median", "category": "mode",
                 "description": "empty_string", "stock": "mean", "brand": "unknown-method"}


@query("fill_missing_sequence", with_(PRODUCTS) + """
, kept AS (SELECT * FROM products WHERE product_name IS NOT NULL)
, med AS (SELECT """ + quantile("kept", "price", 0.5) + """ AS m)
, md AS (SELECT category AS m FROM kept WHERE category IS NOT NULL
         GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 1)
, mn AS (SELECT """ + _mean("stock") + """ AS m FROM kept)
SELECT product_id, product_name, COALESCE(category, (SELECT m FROM md)) AS category,
       COALESCE(CAST(price AS DOUBLE), (SELECT m FROM med)) AS price,
       COALESCE(description, '') AS description,
       COALESCE(CAST(stock AS DOUBLE), (SELECT m FROM mn)) AS stock, brand
FROM kept""")
def fill_missing_sequence(spark, d):
    """C1 with a drop first: later statistics see only the kept rows."""
    return C.handle_missing_values(_products(spark, d), FILL_STRATEGY)


@query("basic_clean_chain", with_(PRODUCTS) + """
, dd AS (SELECT DISTINCT * FROM products)
, mn AS (SELECT """ + _mean("price") + """ AS m FROM dd)
, md AS (SELECT category AS m FROM dd WHERE category IS NOT NULL
         GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 1)
SELECT product_id, product_name, COALESCE(category, (SELECT m FROM md)) AS category,
       COALESCE(CAST(price AS DOUBLE), (SELECT m FROM mn)) AS price,
       COALESCE(description, '') AS description, stock, brand
FROM dd""")
def basic_clean_chain(spark, d):
    """Clean names -> whole-row distinct -> fill (price mean,
    category mode, description empty string)."""
    from martlake.plans.flows import DAG_STRATEGY, basic_transform
    return basic_transform(_products(spark, d).toDF(*MESSY), DAG_STRATEGY)


# ---- SQL builders for C3-C6 ------------------------------------------------

def _norm_sql(src: str, cols: list[str], num: list[str], out: str) -> str:
    stats = ", ".join(f"MIN(CAST({c} AS DOUBLE)) AS mn_{c}, MAX(CAST({c} AS DOUBLE)) AS mx_{c}"
                      for c in num)
    new = ", ".join(f"CASE WHEN mx_{c} > mn_{c} THEN (CAST({c} AS DOUBLE) - mn_{c}) / (mx_{c} - mn_{c}) "
                    f"END AS {c}_normalized" for c in num)
    return (f"{out}_st AS (SELECT {stats} FROM {src}),\n"
            f"{out} AS (SELECT {', '.join(cols)}, {new} FROM {src}, {out}_st)")


def _outlier_sql(src: str, cols: list[str], num: list[str], out: str, method="iqr",
                 k: float = 1.5) -> str:
    parts = []
    for c in num:
        parts.append(f"{quantile(src, c, 0.5)} AS med_{c}")
        if method == "iqr":
            parts.append(f"{quantile(src, c, 0.25)} AS q1_{c}, {quantile(src, c, 0.75)} AS q3_{c}")
        else:
            parts.append(f"(SELECT {_mean(c)} FROM {src}) AS mean_{c}, "
                         f"(SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM {src}) AS std_{c}")
    flags = {}
    for c in num:
        x = f"CAST({c} AS DOUBLE)"
        if method == "iqr":
            cond = (f"({x} < q1_{c} - {k} * (q3_{c} - q1_{c}) OR "
                    f"{x} > q3_{c} + {k} * (q3_{c} - q1_{c}))")
        else:
            cond = f"(abs(({x} - mean_{c}) / NULLIF(std_{c}, 0)) > {k})"
        flags[c] = f"COALESCE({cond}, false)"
    sel = []
    for c in cols:
        if c in flags:
            sel.append(f"CASE WHEN {flags[c]} THEN med_{c} ELSE CAST({c} AS DOUBLE) END AS {c}")
        else:
            sel.append(c)
    sel += [f"{flags[c]} AS {c}_outlier" for c in num]
    return (f"{out}_st AS (SELECT {', '.join(parts)}),\n"
            f"{out} AS (SELECT {', '.join(sel)} FROM {src}, {out}_st)")


def _features_sql(src: str, cols: list[str], out: str) -> str:
    return (f"{out}_med AS (SELECT {quantile(src, 'price', 0.5)} AS m),\n"
            f"{out}_cat AS (SELECT category AS ck, {_mean('price')} AS cavg FROM {src} "
            f"WHERE category IS NOT NULL GROUP BY category),\n"
            f"{out} AS (SELECT {', '.join('s.' + c for c in cols)}, "
            f"COALESCE(s.price > (SELECT m FROM {out}_med), false) AS is_expensive, "
            f"CASE WHEN s.description IS NULL THEN NULL WHEN trim(s.description) = '' THEN 0 "
            f"ELSE CAST(len(regexp_split_to_array(trim(s.description), '\\s+')) AS INTEGER) END AS description_word_count, "
            f"c.cavg AS category_avg_price, "
            f"CAST(s.price AS DOUBLE) / NULLIF(c.cavg, 0) AS price_to_category_avg "
            f"FROM {src} s LEFT JOIN {out}_cat c ON s.category = c.ck)")


NUM = ["price", "stock"]


@query("minmax_scaled", with_(PRODUCTS, _norm_sql("products", PRODUCT_COLS, NUM, "n"))
       + "SELECT * FROM n")
def minmax_scaled(spark, d):
    return X.normalize_numeric_columns(_products(spark, d))


@query("outliers_iqr", with_(PRODUCTS, _outlier_sql("products", PRODUCT_COLS, NUM, "o"))
       + "SELECT * FROM o")
def outliers_iqr(spark, d):
    return X.handle_outliers(_products(spark, d), "iqr", 1.5)


@query("outliers_zscore", with_(PRODUCTS, _outlier_sql("products", PRODUCT_COLS, NUM, "o",
                                                       method="zscore", k=3.0))
       + "SELECT * FROM o")
def outliers_zscore(spark, d):
    return X.handle_outliers(_products(spark, d), "zscore", 3.0)


@query("features", with_(PRODUCTS, _features_sql("products", PRODUCT_COLS, "f"))
       + "SELECT * FROM f")
def features(spark, d):
    return X.generate_features(_products(spark, d))


_N_COLS = PRODUCT_COLS + [f"{c}_normalized" for c in NUM]
_O_NUM = NUM + [f"{c}_normalized" for c in NUM]
_O_COLS = _N_COLS + [f"{c}_outlier" for c in _O_NUM]


@query("feature_chain", with_(PRODUCTS, _norm_sql("products", PRODUCT_COLS, NUM, "n"),
                              _outlier_sql("n", _N_COLS, _O_NUM, "o"),
                              _features_sql("o", _O_COLS, "f"))
       + "SELECT * FROM f")
def feature_chain(spark, d):
    return X.apply_transformations(_products(spark, d))


@query("price_quartiles", with_(PRODUCTS) + """
SELECT """ + quantile("products", "price", 0.25) + " AS q1, " + quantile("products", "price", 0.5)
       + " AS median, " + quantile("products", "price", 0.75) + " AS q3")
def price_quartiles(spark, d):
    """Exact quantiles without a single-task value map."""
    from martlake.operators.stats import exact_quantiles
    return exact_quantiles(_products(spark, d), "price", [0.25, 0.5, 0.75], ["q1", "median", "q3"])


@query("category_mode", with_(PRODUCTS) + """
SELECT category AS mode FROM products WHERE category IS NOT NULL
GROUP BY category ORDER BY COUNT(*) DESC, category LIMIT 1""")
def category_mode(spark, d):
    """Most frequent value, smallest on ties."""
    from martlake.operators.stats import mode_value
    return mode_value(_products(spark, d), "category", "mode")


@query("category_avg_price", with_(PRODUCTS) + f"""
, c AS (SELECT category AS ck, {_mean('price')} AS category_avg_price FROM products
        WHERE category IS NOT NULL GROUP BY category)
SELECT product_id, category, price, category_avg_price
FROM products LEFT JOIN c ON category = ck""")
def category_avg_price(spark, d):
    """Group mean attached to each row."""
    p = _products(spark, d).select("product_id", "category", "price")
    return X.group_mean(p, "category", "price", "category_avg_price")


@query("price_to_global_stats", with_(PRODUCTS) + f"""
, s AS (SELECT MIN(price) AS mn, MAX(price) AS mx, {_mean('price')} AS mean FROM products)
SELECT product_id, price, price - mn AS above_min, mx - price AS below_max,
       price - mean AS from_mean
FROM products, s""")
def price_to_global_stats(spark, d):
    """One-row global statistics attached to every row (as literals)."""
    from martlake.functions.numeric import exact_mean
    p = _products(spark, d)
    from martlake.functions.scalars import scalar_row
    s = scalar_row(p.agg(F.min("price").alias("mn"), F.max("price").alias("mx"),
                         exact_mean("price").alias("mean")))
    return p.select("product_id", "price", (F.col("price") - s["mn"]).alias("above_min"),
                    (s["mx"] - F.col("price")).alias("below_max"),
                    (F.col("price") - s["mean"]).alias("from_mean"))
