"""End-to-end jobs built from the operators (the reference's scripts and
scheduled flows, as single lazy Spark plans).

* :func:`analyze_sales` / :func:`run_sales_job` — the batch sales report
  over given frames: six reports, optionally persisted inputs, run-stamped
  outputs, optional JDBC copy. :func:`analyze_tables` /
  :func:`run_sales_report` build the same reports from the tables, each
  over its smallest input.
* :func:`run_basic_etl` / :func:`run_advanced_etl` — CSV -> cleaning (->
  features) -> load.
* :func:`run_currency_etl` — clean -> validate (none/basic/strict) ->
  currency enrichment -> load -> verify -> one-row run report.
* :func:`run_config` — a configuration row chooses source format,
  transform and target (the generated task graphs of the reference).

There is no scheduler here: each job is one Spark application step; the
hand-over between steps is a lazy DataFrame, not a serialised copy.
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators import cleaning as C
from martlake.operators import currency as CUR
from martlake.operators import features as X
from martlake.operators import quality as Q
from martlake.operators import sales as S
from martlake.session import written
from martlake.sources import files as FS
from martlake.sources import sinks as K

log = logging.getLogger(__name__)


def analyze_sales(customers: DataFrame, sales: DataFrame) -> dict[str, DataFrame]:
    """The six reports of the batch analysis."""
    return {
        "category_stats": S.category_stats(sales),
        "region_stats": S.region_stats(customers, sales),
        "top_customers": S.top_customers(customers, sales, 10),
        "time_analysis": S.time_stats(sales),
        "payment_analysis": S.payment_stats(sales),
        "country_category_analysis": S.country_category(customers, sales),
    }


def analyze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six reports, each over the smallest input that answers it: the
    category report joins no orders, the order-level reports read lines
    pre-aggregated per order, only the country x category report needs the
    full line-level join."""
    from martlake.sources import tables as T
    customers = T.customers(spark, sf_dir)
    by_order = T.order_sales(spark, sf_dir)
    return {
        "category_stats": S.category_stats(T.sales(spark, sf_dir, with_orders=False)),
        "region_stats": S.region_stats(customers, by_order),
        "top_customers": S.top_customers(customers, by_order, 10),
        "time_analysis": S.time_stats(by_order),
        "payment_analysis": S.payment_stats(by_order),
        "country_category_analysis": S.country_category(customers, T.sales(spark, sf_dir)),
    }


def _save_reports(results: dict, out_root: str, run_ts: str, jdbc_url, jdbc_properties) -> dict:
    paths = K.save_results(results, out_root, run_ts)
    if jdbc_url:
        from martlake.sources import jdbc
        # read back the written results instead of re-running the plans
        spark = next(iter(results.values())).sparkSession
        jdbc.save_results({n: spark.read.parquet(p) for n, p in paths.items()},
                          jdbc_url, properties=jdbc_properties)
    return paths


def run_sales_job(customers: DataFrame, sales: DataFrame, out_root: str, run_ts: str,
                  jdbc_url: str | None = None, jdbc_properties: dict | None = None,
                  persist: bool = False) -> dict:
    """The six reports over given frames, written to a run-stamped folder
    (K2) and, when a URL is given, to one table per report (K7).

    ``persist=True`` caches both inputs first (E1): worth it when the sales
    frame is expensive and fits the cluster's memory and disk; at full
    scale prefer :func:`run_sales_report`, which gives each report its own
    minimal input instead of sharing one line-level join."""
    if persist:
        customers = customers.persist(StorageLevel.MEMORY_AND_DISK)
        sales = sales.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _save_reports(analyze_sales(customers, sales), out_root, run_ts,
                             jdbc_url, jdbc_properties)
    finally:
        if persist:
            customers.unpersist()
            sales.unpersist()


def run_sales_report(spark: SparkSession, sf_dir: str, out_root: str, run_ts: str,
                     jdbc_url: str | None = None, jdbc_properties: dict | None = None) -> dict:
    """The batch sales report over the tables of ``sf_dir``
    (:func:`analyze_tables`), written like :func:`run_sales_job`."""
    return _save_reports(analyze_tables(spark, sf_dir), out_root, run_ts, jdbc_url, jdbc_properties)


BASIC_STRATEGY = {"price": "median", "category": "mode", "description": "empty_string"}
DAG_STRATEGY = {"price": "mean", "category": "mode", "description": "empty_string"}


def basic_transform(df: DataFrame, strategy: dict = BASIC_STRATEGY) -> DataFrame:
    """Clean names -> whole-row distinct -> fill. The distinct rows are
    written once; the fill's statistics and the result read that."""
    return C.handle_missing_values(
        written(C.drop_duplicates(C.clean_column_names(df)), "distinct-rows"), strategy)


def run_basic_etl(spark: SparkSession, data_dir: str, file_name: str, target_path: str,
                  schema=None) -> bool:
    """CSV -> C7 -> Parquet. False when the input is missing or empty (the
    target then holds the empty table)."""
    df = FS.extract_csv(spark, data_dir, file_name, schema)
    if df is None:
        return False
    out, rows = Q.observed(basic_transform(df), "basic-etl")
    K.write_parquet(out, target_path)
    return rows.get["rows"] > 0


def run_advanced_etl(spark: SparkSession, data_dir: str, file_name: str, target_path: str,
                     schema=None) -> bool:
    """CSV -> C7 (mean recipe) -> C6 -> Parquet."""
    df = FS.extract_csv(spark, data_dir, file_name, schema)
    if df is None:
        return False
    out = X.apply_transformations(basic_transform(df, DAG_STRATEGY))
    K.write_parquet(out, target_path)
    return True


REPORT_SCHEMA = ("input_path string, input_mb double, input_lines bigint, input_rows bigint, base_currency string, "
                 "target_currencies string, currencies int, target_table string, output_rows bigint, "
                 "error_count int, errors string, status string")


def run_currency_etl(products: DataFrame, rates: DataFrame, target_path: str,
                     level: str = "basic", targets=("USD", "CZK", "GBP", "JPY"),
                     allowed_categories=(), base: str = "EUR", rates_date: str = "1970-01-01",
                     input_path: str | None = None, target_table: str | None = None,
                     report_path: str | None = None) -> DataFrame:
    """The currency flow. Validation reads the cleaned data but does not
    filter it (as in the reference); strict raises before anything is
    written. Returns the one-row run report (Q8), with the messages of the
    validation as errors, and writes it as JSON when a path is given."""
    spark = products.sparkSession
    source, n_in = Q.observed(C.clean_column_names(products), "input")
    cleaned = written(C.drop_duplicates(source), "currency-cleaned")
    rows_in = n_in.get["rows"]
    cleaned = written(C.handle_missing_values(cleaned, DAG_STRATEGY), "currency-filled")
    msgs = Q.enforce(Q.validate(cleaned, level, allowed_categories), level) if level != "none" else []
    enriched, n_out = Q.observed(CUR.transform(cleaned, rates, "price", list(targets), base,
                                               strict=False, rates_date=rates_date), "enriched")
    K.write_parquet(enriched, target_path)
    if target_table:
        K.register_location(spark, target_table, target_path)
    loaded = spark.read.parquet(target_path).count()       # K18
    ok = loaded == n_out.get["rows"] and not msgs
    size = FS.file_sizes(spark, input_path).agg(F.sum("bytes")).first()[0] if input_path else None
    is_text = bool(input_path) and input_path.rstrip("/*").endswith((".csv", ".json", ".txt"))
    lines = FS.text_profile(spark, input_path, by_file=False).first()["lines"] if is_text else None
    report = spark.createDataFrame(
        [(input_path, None if size is None else round(size / (1 << 20), 3), lines, int(rows_in), base,
          ",".join(targets), len(list(targets)), target_table, int(loaded), len(msgs), "; ".join(msgs),
          "OK" if ok else "WARNING")], REPORT_SCHEMA)
    if report_path:
        report.write.mode("overwrite").json(report_path)
    return report


TRANSFORMS = {
    "basic": lambda df: basic_transform(df),
    "advanced": lambda df: X.apply_transformations(basic_transform(df, DAG_STRATEGY)),
    "custom": lambda df: df,
}


def run_config(spark: SparkSession, cfg: dict) -> DataFrame:
    """``{source_type: csv|json|parquet, source_path, transform_type:
    basic|advanced|custom, target_table, target_path?}`` -> the written
    table."""
    fmt = cfg["source_type"]
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if cfg.get("schema"):
            reader = reader.schema(cfg["schema"])
        else:
            reader = reader.option("inferSchema", True)
    elif cfg.get("schema"):
        reader = reader.schema(cfg["schema"])
    df = reader.format(fmt).load(cfg["source_path"])
    out = TRANSFORMS[cfg.get("transform_type", "custom")](df)
    K.save_table(out, cfg["target_table"], "overwrite", "parquet", cfg.get("target_path"))
    return spark.table(cfg["target_table"])
