"""Sinks (K1-K19): files, catalog tables, run-stamped outputs, load checks.

Writers are executed by the executors in parallel; nothing is gathered on
the driver. Only :func:`write_single_csv`, meant for small final reports,
writes from one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IF_EXISTS = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                  compression: str = "snappy") -> None:
    """K1 / K13 / K14."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy") -> None:
    """ORC with SNAPPY."""
    df.write.mode(mode).option("compression", compression).orc(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """K3 / K5."""
    df.write.mode(mode).option("header", header).csv(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """K4: one CSV file — only for small results (one task writes it; what
    makes the rows stays parallel)."""
    df.repartition(1).write.mode("overwrite").option("header", header).csv(path)


def write_text_pairs(df: DataFrame, path: str, key: str, value: str, sep: str = "\t") -> None:
    """K6: ``key<TAB>value`` lines (the Hadoop Streaming format); NULL is
    written as the empty string, with its separator."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, value)]
    (df.select(F.concat(parts[0], F.lit(sep), parts[1]).alias("value"))
     .write.mode("overwrite").text(path))


def run_stamp(run_ts: str) -> str:
    """K2: ``%Y%m%d_%H%M%S`` stamp from a run timestamp parameter
    (``YYYY-MM-DD HH:MM:SS``); the wall clock is never read, so a rerun of
    the same run writes the same place."""
    return run_ts.replace("-", "").replace(":", "").replace(" ", "_")


def save_results(results: dict, root: str, run_ts: str, fmt: str = "parquet") -> dict:
    """Every result to ``<root>/<stamp>/<name>`` with the audit
    column ``analysis_date``; returns the paths."""
    stamp = run_stamp(run_ts)
    paths = {}
    for name, df in results.items():
        p = f"{root.rstrip('/')}/{stamp}/{name}"
        df.withColumn("analysis_date", F.lit(stamp)).write.mode("overwrite").format(fmt).save(p)
        paths[name] = p
    return paths


def save_table(df: DataFrame, table: str, mode: str = "overwrite", fmt: str = "parquet",
               path: str | None = None, partition_by=None) -> None:
    """Catalog table (external when ``path`` is given)."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def register_location(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    """A catalog table over files that are there already."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path, fmt)


def insert_overwrite(spark: SparkSession, table: str, source_sql: str) -> None:
    """``INSERT OVERWRITE TABLE t SELECT ...``."""
    spark.sql(f"INSERT OVERWRITE TABLE {table} {source_sql}")


def create_table_as(spark: SparkSession, table: str, select_sql: str, fmt: str = "orc",
                    location: str | None = None) -> None:
    """``DROP TABLE IF EXISTS`` + CTAS into ORC."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} USING {fmt} OPTIONS (compression 'snappy'){loc} AS {select_sql}")


def verify_load(spark: SparkSession, table: str, expected_rows: int) -> bool:
    """Post-load row count check (one aggregate)."""
    return spark.table(table).count() == expected_rows


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def create_external_csv_table(spark: SparkSession, table: str, schema_ddl: str, location: str,
                              header: bool = True, sep: str = ",") -> None:
    """Delimited-text table over a folder; with ``header`` the
    first line of each file is skipped."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({schema_ddl}) USING csv "
              f"OPTIONS (header '{str(header).lower()}', sep '{sep}') LOCATION '{location}'")


def insert_values(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    """``INSERT INTO t VALUES ...`` with literal rows (bound, not spliced)."""
    df = spark.createDataFrame(rows, spark.table(table).schema)
    df.write.insertInto(table)
