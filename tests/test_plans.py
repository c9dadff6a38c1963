"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shopfunnel.operators import layout, profile
from shopfunnel.plans import behaviour, models
from shopfunnel.plans.catalog import QUERIES
from shopfunnel.sources.tables import read_events
from shopfunnel.sources.testlog import event_log

SF = "/root/testdata/sf0.001"
WRITING = {name for name in QUERIES if re.match("csv_|month_replace|external|clustered|warehouse|stream", name)}


def plan(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    layout.overwrite_events(event_log(spark, SF), root)
    return read_events(spark, root)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_queries_stay_in_the_jvm_and_off_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("Python|Pandas|BatchEval|CartesianProduct|NestedLoop|ExistingRDD", text)


@pytest.mark.parametrize("part", ["event_month = 2024-01", "event_date = 2024-01-05"])
def test_a_filter_on_the_month_or_day_prunes_through_the_fact(stored, part):
    column, value = part.split(" = ")
    daily = models.daily_mart(models.funnel_fact(models.staging(stored)))
    text = plan(daily.filter(F.col(column) == F.lit(value).cast(daily.schema[column].dataType)), "formatted")
    assert column in re.search(r"PartitionFilters: \[(.*?)\]\n", text).group(1)


def test_the_daily_mart_reads_only_its_columns(stored):
    text = plan(models.daily_mart(models.funnel_fact(models.staging(stored))), "formatted")
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "event_time:" not in schema and "category_id" not in schema
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", text).group(1)
    assert "In(event_type, [cart,purchase,view])" in pushed and "IsNotNull(user_session)" in pushed


def test_the_marts_shuffle_twice_and_never_the_raw_events(stored):
    text = plan(models.daily_mart(models.funnel_fact(models.staging(stored))))
    assert text.count("Exchange hashpartitioning") == 2
    for exchange in text.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in exchange.split("\n")[1] and "partial_" in exchange.split("\n")[1]


def test_views_are_shuffled_once_to_the_pairs_bought(stored):
    text = plan(behaviour.views_before_purchase(models.staging(stored)), "formatted")
    scans = re.findall(r"PushedFilters: \[(.*?)\]\n", text)
    assert sum("EqualTo(event_type,view)" in s for s in scans) == 1
    assert not re.search("Window|Python", text)


def test_views_of_one_hot_pair_are_split(spark):
    settings = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = spark.range(0, 400_000, 1, 16).selectExpr(
            "if(id % 3 = 0, 1, id % 5000) as user_id",
            "if(id % 3 = 0, 1, id % 7) as product_id",
            "timestamp_seconds(1700000000 + xxhash64(id) % 1000000) as event_time",
            "if(id % 50 = 3, 'purchase', 'view') as event_type",
            "'main' as category_main",
        )
        found = behaviour.views_before_purchase(hot)
        row = found.collect()
        assert "skew=true" in plan(found)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert row == behaviour.views_before_purchase(hot).collect()
    first = hot.filter("event_type = 'purchase'").groupBy("user_id", "product_id").agg(F.min("event_time").alias("at"))
    views = hot.filter("event_type = 'view'").join(F.broadcast(first), ["user_id", "product_id"]).filter("event_time < at")
    assert [(r.products_bought, r.views_before) for r in row] == [(first.count(), views.count())]


def test_statistics_shuffle_the_data_once(spark, stored):
    df = profile.numeric_summary(stored)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
