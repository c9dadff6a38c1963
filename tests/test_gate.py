from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopfunnel.functions.events import any_conversion_failed, parse_event_time
from shopfunnel.operators import gate
from shopfunnel.schemas import BRONZE, PROCESSED
from tests.rows import CLEAN, bronze


def test_a_row_that_fails_is_flagged_with_every_failing_column(spark):
    bad = {"product_id": "bad", "category_id": "bad", "price": "bad", "user_id": "bad"}
    typed = gate.with_typed(bronze(spark, {}, bad))
    assert typed.filter(any_conversion_failed()).count() == 1
    (row,) = gate.quarantined(typed).collect()
    assert row.failure_reason == "product_id, category_id, price, user_id"
    assert row.product_id_raw == "bad" and row.event_time_raw == CLEAN["event_time"]


def test_processed_rows_have_the_declared_types(spark):
    rows = gate.processed(gate.with_typed(bronze(spark, {}, {"event_time": "5 March"})))
    assert rows.schema == PROCESSED
    (row,) = rows.collect()
    assert (row.event_type, row.product_id, row.user_id, row.price) == ("view", 58, 417, 23.75)


def test_partition_columns_come_from_the_utc_time(spark):
    typed = gate.with_typed(bronze(spark, {"event_time": "2024-02-29 23:00:01 UTC"}))
    (row,) = gate.with_partition_columns(gate.processed(typed)).collect()
    assert row.event_month == "2024-02"
    assert row.event_date == dt.date(2024, 2, 29)
    assert row.event_month_date == dt.date(2024, 2, 1)


@pytest.mark.parametrize(
    ("defect", "reason", "kept"),
    [
        ({}, None, True),
        ({"price": "x"}, "price", True),
        ({"category_id": "x"}, "category_id", True),
        ({"product_id": "x"}, "product_id", False),
        ({"user_id": "x"}, "user_id", False),
        ({"event_time": "x"}, "event_time", False),
        ({"user_id": None}, None, False),
        ({"product_id": None}, None, False),
        ({"event_time": None}, None, False),
        ({"price": None}, None, True),
        ({"category_id": None}, None, True),
        ({"brand": None}, None, True),
        ({"category_code": None}, None, True),
        ({"price": "x", "user_id": None}, "price", False),
    ],
)
def test_routing(spark, defect, reason, kept):
    typed = gate.with_typed(bronze(spark, defect)).cache()
    assert [r.failure_reason for r in gate.quarantined(typed).collect()] == ([reason] if reason else [])
    rows = gate.processed(typed).collect()
    assert len(rows) == kept
    if kept:
        for column in ("price", "category_id"):
            assert (rows[0][column] is None) == (column in defect)


def test_metrics_account_for_every_row(spark):
    raw = bronze(spark, {}, {"price": "x"}, {"user_id": "x"}, {"user_id": None}, {"event_time": None, "price": "x"})
    row = gate.row_metrics(gate.with_typed(raw)).first().asDict()
    assert row == {
        "total": 5,
        "cast_failed": 3,
        "processed": 2,
        "dropped_bad_key": 1,
        "dropped_null_key": 2,
        "cast_failed_rate": 0.6,
        "processed_rate": 0.4,
    }


def test_metrics_of_no_rows(spark):
    row = gate.row_metrics(gate.with_typed(spark.createDataFrame([], BRONZE))).first()
    assert (row.total, row.cast_failed_rate, row.processed_rate) == (0, 0.0, 0.0)


@pytest.mark.parametrize(
    ("text", "value"),
    [("12", 12), (" 12 ", 12), ("+5", 5), ("12.7", None), ("1e3", None), ("9223372036854775808", None), ("", None)],
)
def test_ids(spark, text, value):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert gate.with_typed(bronze(spark, {"product_id": text})).first().product_id_typed == value


def test_special_prices(spark):
    rows = gate.with_typed(bronze(spark, {"price": "1d"}, {"price": "Infinity"}, {"price": "-0.5"})).collect()
    assert [r.price_typed for r in rows] == [1.0, float("inf"), -0.5]


TIMES = st.one_of(
    st.datetimes(dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31)).map(lambda t: t.isoformat(" ", "seconds")),
    st.from_regex(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\Z"),
    st.from_regex(r"\A[0-2]?[0-9]{3}-[0-1]?[0-9]-[0-3]?[0-9][ T][0-2]?[0-9]:[0-5]?[0-9]:[0-5]?[0-9](\.[0-9])?\Z"),
    st.text("0123456789-: UTCutc.\n\tZ+", max_size=24),
)
SUFFIXES = st.sampled_from(["", " UTC", " utc", "UTC", " UTC UTC", " UTC ", " UTC\n", "Z", "\n", " "])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TIMES, SUFFIXES), min_size=60, max_size=200))
def test_times_parse_as_the_strict_format_does(spark, parts):
    texts = [(time + suffix,) for time, suffix in parts]
    strict = F.try_to_timestamp(F.regexp_replace("t", " UTC$", ""), F.lit("yyyy-MM-dd HH:mm:ss"))
    rows = (
        spark.createDataFrame(texts, "t string")
        .select("t", parse_event_time(F.col("t")).cast("string").alias("ours"), strict.cast("string").alias("strict"))
        .filter(~F.equal_null("ours", "strict"))
        .collect()
    )
    assert rows == []


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2019-10-01 00:00:00 UTC", dt.datetime(2019, 10, 1)),
        ("2019-10-01 00:00:00", dt.datetime(2019, 10, 1)),
        ("2019-10-1 0:00:00 UTC", None),
        ("2019-10-01 00:00:00.5", None),
        ("2019-10-01T00:00:00", None),
        ("2019-10-01 00:00:00 ", None),
        ("2019-02-30 00:00:00", None),
    ],
)
def test_times(spark, text, value):
    assert gate.with_typed(bronze(spark, {"event_time": text})).first().event_time_typed == value


def test_row_ids_are_unique(spark):
    ids = gate.with_row_id(spark.range(0, 1000, 1, 7)).select("_row_id")
    assert ids.distinct().count() == 1000


def test_failures_by_column(spark):
    raw = bronze(spark, {"price": "x"}, {"price": "y", "user_id": "z"}, {})
    found = {r.column_name: r.failures for r in gate.failures_by_column(gate.with_typed(raw)).collect()}
    assert found == {"event_time": 0, "product_id": 0, "category_id": 0, "price": 2, "user_id": 1}


def test_flow_from_raw_to_partitioned(spark):
    raw = bronze(spark, {}, {"event_type": "cart", "event_time": "2019-10-01 00:01:00 UTC"})
    rows = gate.with_partition_columns(gate.processed(gate.with_typed(raw)))
    assert rows.count() == 2
    assert {"event_month", "event_date", "event_month_date"} <= set(rows.columns)
