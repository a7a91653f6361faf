"""End-to-end jobs: write, read back, check."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from martlake.plans import flows
from martlake.sources import tables as T

RATES = {"USD": 1.1, "CZK": 25.5}


def test_sales_job_writes_six_stamped_reports(spark, tmp_path):
    paths = flows.run_sales_job(T.customers(spark, SF_SMALL), T.sales(spark, SF_SMALL),
                                str(tmp_path / "out"), "2025-01-31 23:59:59", persist=True)
    assert len(paths) == 6
    for name, p in paths.items():
        assert "/20250131_235959/" in p
        df = spark.read.parquet(p)
        assert df.count() > 0 and "analysis_date" in df.columns
    top = spark.read.parquet(paths["top_customers"])
    assert top.count() == 10


def test_sales_job_jdbc_copy(spark, tmp_path, monkeypatch):
    """K7: what would be loaded, and into which tables; no database is opened."""
    from martlake.sources import jdbc
    loaded = {}
    monkeypatch.setattr(jdbc, "load_data", lambda df, url, table, mode, props: loaded.update({table: (df.count(), mode)}))
    flows.run_sales_job(T.customers(spark, SF_SMALL), T.sales(spark, SF_SMALL),
                        str(tmp_path / "out"), "2025-01-31 23:59:59", "jdbc:x:y", {})
    assert len(loaded) == 6 and loaded["sales_analysis_category_stats"] == (6, "replace")


def test_scratch_is_cleaned(spark):
    from martlake import session as SE
    kept, SE._SCRATCH[:] = list(SE._SCRATCH), []
    try:
        t = SE.written(spark.range(3), "clean-me")
        path = SE._SCRATCH[0]
        spark.range(2).write.option("path", f"{SE.scratch_path(spark, 'clean-table')}").saveAsTable("clean_me_table")
        assert t.count() == 3 and SE.clean_scratch(spark) == 2
        assert not spark.catalog.tableExists("clean_me_table")
        with pytest.raises(Exception):
            spark.read.parquet(path)
    finally:
        SE._SCRATCH[:] = kept


def _products_csv(spark, tmp_path):
    p = tmp_path / "in"
    (T.products(spark, SF_SMALL).toDF(" Product ID", "Product Name ", "CATEGORY", " Price",
                                      "Description", "Stock ", "BRAND")
     .coalesce(1).write.option("header", True).csv(str(p / "products")))
    return str(p), "products"


def test_basic_and_advanced_etl(spark, tmp_path):
    data_dir, name = _products_csv(spark, tmp_path)
    out = str(tmp_path / "basic")
    assert flows.run_basic_etl(spark, data_dir, name, out)
    df = spark.read.parquet(out)
    assert df.where(F.col("price").isNull()).count() == 0
    assert df.where(F.col("description").isNull()).count() == 0
    assert not flows.run_basic_etl(spark, data_dir, "missing.csv", out)
    adv = str(tmp_path / "adv")
    assert flows.run_advanced_etl(spark, data_dir, name, adv)
    cols = spark.read.parquet(adv).columns
    for c in ("price_normalized", "price_outlier", "price_normalized_outlier", "is_expensive",
              "description_word_count", "category_avg_price", "price_to_category_avg"):
        assert c in cols


def test_currency_etl_levels(spark, tmp_path):
    from martlake.operators.currency import rates_frame
    products = T.products(spark, SF_SMALL)
    rates = rates_frame(spark, RATES)
    rep = flows.run_currency_etl(products, rates, str(tmp_path / "cur"), "basic",
                                 ["USD", "CZK", "XXX"]).collect()[0]
    assert rep.input_rows == rep.output_rows == products.count()
    assert rep.status == "WARNING" and rep.error_count == 1 and rep.errors.startswith("empty_category")
    twice = flows.run_currency_etl(products.unionByName(products), rates, str(tmp_path / "cur3"), "none", ["USD"],
                                   target_table="cur3", report_path=str(tmp_path / "report")).collect()[0]
    assert twice.input_rows == 2 * twice.output_rows and twice.status == "OK" and twice.target_table == "cur3"
    assert spark.table("cur3").count() == twice.output_rows
    assert spark.read.json(str(tmp_path / "report")).first().output_rows == twice.output_rows
    written = spark.read.parquet(str(tmp_path / "cur"))
    assert {"price_USD", "price_CZK", "available_currencies"} <= set(written.columns)
    with pytest.raises(ValueError):
        flows.run_currency_etl(products, rates, str(tmp_path / "cur2"), "strict", ["USD"],
                               allowed_categories=["STANDARD"])


def test_config_csv_source(spark, tmp_path):
    data_dir, name = _products_csv(spark, tmp_path)
    cfg = {"source_type": "csv", "source_path": f"{data_dir}/{name}", "transform_type": "custom",
           "target_table": "cfg_products_csv", "target_path": str(tmp_path / "t")}
    out = flows.run_config(spark, cfg)
    assert out.count() == T.products(spark, SF_SMALL).count()


def test_table_report_equals_frame_report(spark, tmp_path):
    """The per-report minimal inputs give the same six reports as the shared
    line-level frame."""
    a = flows.analyze_tables(spark, SF_SMALL)
    b = flows.analyze_sales(T.customers(spark, SF_SMALL), T.sales(spark, SF_SMALL))
    assert a.keys() == b.keys()
    for k in a:
        assert sorted(map(tuple, a[k].collect())) == sorted(map(tuple, b[k].collect())), k
