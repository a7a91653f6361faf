"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import scratch_path

#: One run of the blanks that separate words, as a Java regular expression.
BLANKS = r"[\x20\x09-\x0D]+"
#: One word.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def written(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder.

    Cuts the lineage: what follows survives the loss of an executor without
    running ``df`` again, and reads only the columns it needs. Tables of short
    rows go to at most two files for each core; ``wide`` keeps one file for
    each task, for what comes out of a scan of texts or a large shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not wide:
        df = df.coalesce(2 * max(1, spark.sparkContext.defaultParallelism))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch: texts are long, and a worker holds a few copies.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Ready for Python workers: batches are bounded in bytes, and this library
    is sent to them (once for each session), so that functions used in
    ``mapInArrow`` can be imported there."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_martlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="martlake-code-"), "martlake_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._martlake_shipped = True


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file of the public tokenizers lies."""
    import public_tokenizers
    return public_tokenizers.path(name)
