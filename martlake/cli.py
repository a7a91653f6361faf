"""Command-line jobs (``python -m martlake <command>`` or ``spark-submit``).

Each command builds (or reuses) a session, runs one of the flows and writes
its output; nothing is collected to the driver except small reports.

    sales-report  --data DIR --out DIR [--run-ts TS] [--jdbc-url URL]
    wordcount     --text PATH [--format parquet|text] [--column text]
                  [--tokenizer ws|case|stripped|nonword] [--top K] --out DIR
    clean         --data-dir DIR --file NAME --out DIR [--advanced]
    currency      --products PATH --rates PATH --out DIR [--level none|basic|strict]
                  [--targets USD,CZK,...] [--base EUR] [--rates-date YYYY-MM-DD]
    run-config    CONFIG.json
"""

from __future__ import annotations

import argparse
import json
import sys


def _session():
    from pyspark.sql import SparkSession
    from martlake.session import configure
    return configure(SparkSession.builder.appName("martlake").getOrCreate())


def cmd_sales_report(a) -> int:
    from martlake.plans import flows
    spark = _session()
    paths = flows.run_sales_report(spark, a.data, a.out, a.run_ts, a.jdbc_url)
    print(json.dumps(paths))
    return 0


def cmd_wordcount(a) -> int:
    from martlake.operators import text as X
    spark = _session()
    if a.format == "text":
        df = spark.read.text(a.text).withColumnRenamed("value", a.column)
    else:
        df = spark.read.parquet(a.text)
    counts = X.word_counts(df, a.column, a.tokenizer)
    counts.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/counts")
    if a.top:
        top = X.top_words(spark.read.parquet(f"{a.out.rstrip('/')}/counts"), a.top)
        top.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{a.out.rstrip('/')}/top")
    return 0


def cmd_clean(a) -> int:
    from martlake.plans import flows
    spark = _session()
    run = flows.run_advanced_etl if a.advanced else flows.run_basic_etl
    return 0 if run(spark, a.data_dir, a.file, a.out) else 1


def cmd_currency(a) -> int:
    from martlake.operators import currency as CUR
    from martlake.plans import flows
    spark = _session()
    products = spark.read.option("header", True).option("inferSchema", True).csv(a.products)
    rates = CUR.rates_from_json_files(spark, a.rates)
    report = flows.run_currency_etl(products, rates, a.out, a.level, a.targets.split(","),
                                    base=a.base, rates_date=a.rates_date)
    print(json.dumps(report.first().asDict()))
    return 0


def cmd_run_config(a) -> int:
    from martlake.plans import flows
    spark = _session()
    with open(a.config) as f:
        cfg = json.load(f)
    for c in cfg if isinstance(cfg, list) else [cfg]:
        flows.run_config(spark, c)
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="martlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("sales-report")
    s.add_argument("--data", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--run-ts", default="1970-01-01 00:00:00")
    s.add_argument("--jdbc-url")
    s.set_defaults(fn=cmd_sales_report)
    w = sub.add_parser("wordcount")
    w.add_argument("--text", required=True)
    w.add_argument("--format", default="parquet", choices=["parquet", "text"])
    w.add_argument("--column", default="text")
    w.add_argument("--tokenizer", default="ws", choices=["ws", "case", "stripped", "nonword"])
    w.add_argument("--top", type=int, default=20)
    w.add_argument("--out", required=True)
    w.set_defaults(fn=cmd_wordcount)
    c = sub.add_parser("clean")
    c.add_argument("--data-dir", required=True)
    c.add_argument("--file", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--advanced", action="store_true")
    c.set_defaults(fn=cmd_clean)
    r = sub.add_parser("currency")
    r.add_argument("--products", required=True)
    r.add_argument("--rates", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--level", default="basic", choices=["none", "basic", "strict"])
    r.add_argument("--targets", default="USD,CZK,GBP,JPY")
    r.add_argument("--base", default="EUR")
    r.add_argument("--rates-date", default="1970-01-01")
    r.set_defaults(fn=cmd_currency)
    g = sub.add_parser("run-config")
    g.add_argument("config")
    g.set_defaults(fn=cmd_run_config)
    a = p.parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
