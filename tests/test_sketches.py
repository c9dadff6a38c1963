from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shopfunnel.operators import sketches
from shopfunnel.schemas import PROCESSED
from tests.rows import events


def many(spark, n=60_000):
    """A third of the rows on one day; products, sessions and missing brands over two months."""
    day = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 59).cast("int")
    return spark.range(0, n, 1, 8).select(
        F.date_add(F.lit("2019-10-01"), day).alias("event_date"),
        (F.col("id") * 7 % 20_011).alias("product_id"),
        F.concat(F.lit("s"), F.col("id") % 9_001).alias("user_session"),
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise((F.col("id") % 37).cast("string")).alias("brand"),
        (F.col("id") % 501 / 4).alias("price"),
    ).withColumn("event_month", F.date_format("event_date", "yyyy-MM"))


COLUMNS = ["product_id", "user_session", "brand", "price"]
RANGES = [
    (date(2019, 10, 6), date(2019, 10, 6)),
    (date(2019, 10, 1), date(2019, 10, 31)),
    (date(2019, 10, 20), date(2019, 11, 20)),
    (date(2019, 10, 1), date(2019, 11, 30)),
]


def test_ranges_are_counted_within_the_bound(spark, tmp_path):
    log = many(spark)
    sketches.day_sketches(log, COLUMNS).write.partitionBy("event_month").parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    told = {(r.first_day, r.last_day, r.column_name): r.distinct_values for r in sketches.distinct_in_ranges(kept, RANGES).collect()}
    assert len(told) == len(RANGES) * len(COLUMNS)
    for first, last in RANGES:
        exact = log.filter(F.col("event_date").between(first, last)).agg(*[F.count_distinct(c).alias(c) for c in COLUMNS]).first()
        for c in COLUMNS:
            assert abs(told[first, last, c] - exact[c]) <= sketches.error_bound() * exact[c], (first, last, c)
    one = {r.column_name: r.distinct_values for r in sketches.distinct_between(kept, *RANGES[2]).collect()}
    assert one == {c: told[(*RANGES[2], c)] for c in COLUMNS}


def test_only_months_of_the_range_are_read(spark, tmp_path):
    sketches.day_sketches(many(spark, 3_000), COLUMNS).write.partitionBy("event_month").parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    plan = sketches.distinct_between(kept, *RANGES[0])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_month" in filters and "2019-10" in filters


def test_missing_empty_and_odd_values(spark):
    rows = [{"brand": ""}, {"brand": None, "price": None}, {"brand": "x", "price": 0.0}, {"price": -0.0}, {"price": float("nan")}]
    kept = sketches.day_sketches(events(spark, *rows), PROCESSED.names)
    found = {r.column_name: r.distinct_values for r in sketches.distinct_between(kept, date(2019, 10, 1), date(2019, 10, 1)).collect()}
    assert (found["brand"], found["price"], found["event_time"]) == (3, 3, 1)  # '', 'x', 'oakley'; 10, 0, NaN
    assert set(found) == set(PROCESSED.names)


def test_no_days(spark):
    empty = sketches.day_sketches(events(spark, {}).limit(0), COLUMNS)
    assert sketches.distinct_between(empty, *RANGES[0]).count() == 0
    nulls = sketches.day_sketches(events(spark, {"brand": None}), ["brand"])
    assert sketches.distinct_between(nulls, *RANGES[1]).first().distinct_values == 0
    with pytest.raises(ValueError, match="no ranges"):
        sketches.distinct_in_ranges(empty, [])
