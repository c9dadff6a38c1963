"""Cleaning and packing a corpus: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopfunnel.llm import stages
from shopfunnel.session import remove, work_path

STAGES = [
    ("quality_classifier", stages.drop_low_quality),
    ("ngram_jaccard_join", stages.drop_near_duplicates),
    ("substring_dedup", stages.drop_repeated_passages),
    ("benchmark_decontamination", stages.drop_leaks),
    ("packing", stages.pack_sequences),
]

#: The stages are models and similarity searches that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; what a stage wrote goes when the next is done.

    Null and empty texts, repeated rows and null ids go through as each stage states; a table
    without rows gives none.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
