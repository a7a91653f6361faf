"""File and catalog sources.

Explicit schemas are preferred everywhere (inference reads the data twice
and guesses types); inference is offered only for exploration (S1).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

log = logging.getLogger(__name__)


def read_csv_inferred(spark: SparkSession, path: str, **options) -> DataFrame:
    """Header + inferred types (two passes over the file)."""
    return spark.read.options(header=True, inferSchema=True, **options).csv(path)


def read_csv(spark: SparkSession, path: str, schema, header: bool = True, **options) -> DataFrame:
    """CSV with an explicit schema (DDL string or StructType)."""
    return spark.read.schema(schema).options(header=header, **options).csv(path)


def read_csv_headerless(spark: SparkSession, path: str, names) -> DataFrame:
    """S3: headerless CSV, then every column renamed."""
    return spark.read.options(header=False, inferSchema=True).csv(path).toDF(*names)


def extract_csv(spark: SparkSession, data_dir: str, filename: str, schema=None,
                **options) -> DataFrame | None:
    """CSV file of a directory with pass-through options. A missing
    path gives ``None`` (the reference's contract); malformed rows are kept
    with the raw line in ``_corrupt_record`` (PERMISSIVE) when a schema is
    given."""
    path = f"{data_dir.rstrip('/')}/{filename}"
    try:
        r = spark.read.options(header=True, **options)
        if schema is not None:
            from pyspark.sql.types import StringType, StructField, StructType
            st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
            if "_corrupt_record" not in st.fieldNames():
                st = StructType(st.fields + [StructField("_corrupt_record", StringType(), True)])
            r = r.schema(st).option("mode", "PERMISSIVE") \
                .option("columnNameOfCorruptRecord", "_corrupt_record")
        else:
            r = r.option("inferSchema", True)
        df = r.csv(path)
        df.schema  # resolves the path now
        return df
    except AnalysisException as e:
        log.error("cannot read %s: %s", path, e)
        return None


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """S8."""
    return spark.read.orc(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in ``value``."""
    return spark.read.text(path)


def read_nested_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines with nested structs, flattened by dotted paths."""
    return spark.read.schema(schema).json(path)


SENSOR_SCHEMA = ("timestamp string, source string, "
                 "readings struct<temperature: double, humidity: double, pressure: double>, "
                 "metadata struct<device_id: string, location: string, debug_mode: boolean>")


def flatten_sensor(df: DataFrame) -> DataFrame:
    """Nested sensor record -> flat columns."""
    return df.select(F.to_timestamp("timestamp").alias("timestamp"), "source",
                     F.col("readings.temperature").alias("temperature"),
                     F.col("readings.humidity").alias("humidity"),
                     F.col("readings.pressure").alias("pressure"),
                     F.col("metadata.device_id").alias("device_id"),
                     F.col("metadata.location").alias("location"))


def _canonical(x: Column, kind: T.DataType) -> Column:
    """The value as text, exact and the same in every engine: doubles with all
    their bits as hexadecimal fractions, times as microseconds, lists by element."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.regexp_replace(F.format_string("%a", x.cast("double")), r"\.0p", "p")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(x.cast("timestamp")).cast("string")
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(x, lambda e: F.coalesce(
            _canonical(e, kind.elementType), F.lit("null"))), ","), F.lit("]"))
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.to_json(x)
    return x.cast("string")


def row_hash(schema: T.StructType) -> Column:
    """60 bits of the SHA-256 of a row: each value behind its length, so that
    no two rows are one text; nulls are a sign of their own."""
    parts = []
    for f in schema.fields:
        x = F.col(f"`{f.name}`")
        text = _canonical(x, f.dataType)
        parts.append(F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.char_length(text).cast("string"), F.lit(":"), text)))
    return F.conv(F.substring(F.sha2(F.concat(*parts), 256), 1, 15), 16, 10).cast("decimal(20,0)")


def table_profile(df: DataFrame, by_file: bool = False) -> DataFrame:
    """S18 / S19 for tables of any size and format: rows and a checksum of the
    content, the sum of the rows' hashes; per file also path, size_mb and bytes.
    The checksum is the same in whatever order, files and splits the rows lie,
    so it tells whether two tables hold the same rows. Files are read in splits
    by many tasks, and nothing holds one whole."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_h"), F.lit(0)).cast("string").alias("checksum")]
    hashed = row_hash(df.schema).alias("_h")
    if not by_file:
        return df.select(hashed).agg(*aggs)
    size = F.col("_metadata.file_size")
    return (df.select(F.col("_metadata.file_path").alias("path"), size.alias("bytes"), hashed).groupBy("path", "bytes").agg(*aggs)
            .select("path", F.round(F.col("bytes") / F.lit(1024 * 1024), 3).alias("size_mb"), "bytes", "rows", "checksum"))


def file_sizes(spark: SparkSession, path_glob: str) -> DataFrame:
    """Path, size in MB and bytes of the files of any size; their content
    is not read."""
    files = spark.read.format("binaryFile").load(path_glob)
    return files.select("path", F.round(F.col("length") / F.lit(1024 * 1024), 3).alias("size_mb"), F.col("length").alias("bytes"))


def text_profile(spark: SparkSession, path: str, by_file: bool = True) -> DataFrame:
    """S18 / S19 for text files of any size: per file (or over all) the
    number of lines, their characters and a checksum, the sum of the leading
    60 bits of each line's SHA-256. A file is read in splits, line by line;
    nothing holds it whole."""
    bits = F.conv(F.substring(F.sha2("value", 256), 1, 15), 16, 10).cast("decimal(20,0)")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    aggs = [F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("value")).cast("bigint").alias("chars"),
            F.sum(bits).cast("string").alias("checksum")]
    return lines.groupBy("path").agg(*aggs) if by_file else lines.agg(*aggs)


def register_temp_view(df: DataFrame, name: str) -> DataFrame:
    """Temp view, so the same plan is reachable from SQL text."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL text with named parameters bound by Spark (no string
    splicing of values)."""
    return spark.sql(text, args=params) if params else spark.sql(text)
