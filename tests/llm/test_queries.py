from __future__ import annotations

import pytest

import corpus_pipeline
from shopfunnel.llm import queries
from shopfunnel.llm.common import table
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(SF), SF, name) is None


def test_stages_of_the_pipeline(spark):
    """Each stage keeps the columns of documents, and what it keeps is there before it."""
    docs = table(spark, SF, "documents")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, SF)
        assert after.columns == docs.columns, name
        assert after.count() > 0.5 * left.count(), name
        assert after.join(left, "doc_id", "left_anti").count() == 0, name
        left = after
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert packed.select("doc_id").distinct().count() == left.count()


def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows and an empty table go through every stage."""
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, None, "en", "s", 0), (-3, "a few words", "en", "s", 11), (-3, "a few words", "en", "s", 11)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        assert stage(spark, odd, SF).count() >= 0, name
    stages = dict(corpus_pipeline.STAGES)
    assert stages["ngram_jaccard_join"](spark, odd, SF).filter("doc_id = -3").count() == 1


def test_stages_keep_rows_that_nothing_is_wrong_with(spark):
    """Rows with the id of a leaked one, and rows that had no word before anything was cut."""
    docs, stages = table(spark, SF, "documents"), dict(corpus_pipeline.STAGES)
    item = table(spark, SF, "benchmark").filter("length(text) > 100").first().text
    texts = [(None, item), (None, "kept without an id"), (None, None), (-1, item), (-1, "kept under the same id"), (-2, ""), (-3, "  ")]
    odd = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], docs.schema)
    left = stages["benchmark_decontamination"](spark, odd, SF)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted((i or 0, t or "") for i, t in texts if t != item)
    empty = odd.filter("doc_id < -1 or text is null")
    assert stages["substring_dedup"](spark, empty, SF).count() == 3
