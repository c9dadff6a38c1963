"""Stages of the corpus pipeline: each takes documents and returns what it keeps of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.llm import quality
from shopfunnel.llm.common import fresh, table
from shopfunnel.llm.decontaminate import find_leaks
from shopfunnel.llm.ngram_join import near_groups, row_key
from shopfunnel.llm.packing import pack
from shopfunnel.llm.substrings import dedup_substrings


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably toxic or of low quality go."""
    ratings = table(spark, sf_dir, "labels").select("doc_id", quality.grade().alias("grade"))
    return quality.select(docs, quality.train_on_all(docs, ratings, top=2), wanted=2).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays.

    Documents without words are no duplicates of each other. Of repeated rows one stays. Groups
    without any id stay whole.
    """
    groups = near_groups(docs).filter("component_id is null or id = component_id").select("row").distinct()
    row = fresh(docs, "row")
    kept = docs.withColumn(row, row_key("doc_id", "text")).join(groups.withColumnRenamed("row", row), row, "left_semi")
    return kept.dropDuplicates([row]).select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out, and documents of which no word is left go."""
    left = dedup_substrings(docs).filter("n_removed = 0 or n_words > n_removed")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go: rows by id and text, whatever others have their id."""
    row = fresh(docs, "row")
    keyed = docs.withColumn(row, row_key("doc_id", "text"))
    leaked = find_leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=row).select(F.col("doc_id").alias(row)).distinct()
    return keyed.join(leaked, row, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of what is left, with their ids."""
    return pack(docs)
