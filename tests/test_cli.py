"""Command-line jobs run in-process on the test session."""

import json

from tests.conftest import SF_SMALL

from martlake.cli import main


def test_sales_report_command(spark, tmp_path):
    assert main(["sales-report", "--data", SF_SMALL, "--out", str(tmp_path),
                 "--run-ts", "2025-01-31 23:59:59"]) == 0
    assert spark.read.parquet(str(tmp_path / "20250131_235959" / "region_stats")).count() == 5


def test_wordcount_command_text_files(spark, tmp_path):
    src = tmp_path / "t.txt"
    src.write_text("It's a kůň\nit's A kůň\n")
    out = tmp_path / "wc"
    assert main(["wordcount", "--text", str(src), "--format", "text", "--tokenizer", "nonword",
                 "--out", str(out), "--top", "2"]) == 0
    got = {r.word: r["count"] for r in spark.read.parquet(str(out / "counts")).collect()}
    assert got == {"it": 2, "s": 2, "a": 2, "kůň": 2}
    assert spark.read.option("header", True).csv(str(out / "top")).count() == 2


def test_currency_command(spark, tmp_path):
    prod = tmp_path / "products.csv"
    prod.write_text("product_id,product_name,category,price,description\n"
                    "1,Widget,Tools,10.0,small\n2,Gadget,,20.5,\n")
    rates = tmp_path / "rates.json"
    rates.write_text(json.dumps({"base": "EUR", "rates": {"USD": 1.1, "CZK": 25.5}}))
    out = tmp_path / "cur"
    assert main(["currency", "--products", str(prod), "--rates", str(rates), "--out", str(out),
                 "--targets", "USD,CZK,XXX"]) == 0
    rows = {r.product_id: r for r in spark.read.parquet(str(out)).collect()}
    assert rows[1].price_USD == 11.0 and rows[2].price_CZK == 522.75


def test_run_config_command(spark, tmp_path):
    src = tmp_path / "in.json"
    src.write_text('{"id": 1, "price": 2.0}\n{"id": 2, "price": null}\n')
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"source_type": "json", "source_path": str(src),
                               "transform_type": "custom", "target_table": "cli_cfg_t",
                               "target_path": str(tmp_path / "t")}))
    assert main(["run-config", str(cfg)]) == 0
    assert spark.table("cli_cfg_t").count() == 2
