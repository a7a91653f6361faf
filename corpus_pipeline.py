"""From raw documents to packed training sequences.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
frame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``docs``:

1. quality classifier: rows that score below the threshold go;
2. exact dedup: one row of each group of equal texts stays;
3. SimHash near-dedup: one row of each group of near copies stays;
4. mixing: each row appears as often as the mix takes it;
5. packing: one row per piece of a token sequence.

Nulls, empty texts and tables, ties, repeated rows and further columns have
the results that the operators' docstrings define; further columns pass
through the first four stages unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlake.llm import common, exact_dedup, mixing, packing, quality_classifier, simhash_dedup


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of rows that are no held-out ones."""
    return quality_classifier.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, common.tokenizer_path(packing.VOCABULARY), common.tokenizer_path(packing.RANKS))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier's fit, the fingerprints and the token ids are beyond SQL;
#: tests/llm/test_pipeline.py holds the dedup stages against brute force, the
#: other stages against their operators' results, offsets and totals.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), wide=True)
    return docs
