from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopfunnel.plans import models
from shopfunnel.schemas import DAILY, FACT, MONTHLY, STAGING
from shopfunnel.sources.testlog import event_log
from tests.rows import events

STAGE_TYPES = ("view", "cart", "purchase")


def fact_of(spark, *rows):
    return models.funnel_fact(models.staging(events(spark, *rows)))


GOLDEN = [
    # flags, stage, monthly counts, monthly rates, daily rates
    ((1, 0, 0), "view", (1, 0, 0), (0, None, 0), (0, None, 0)),
    ((1, 1, 0), "cart", (1, 1, 0), (100, 0, 0), (100, 0, 0)),
    ((1, 1, 1), "purchase", (1, 1, 1), (100, 100, 100), (100, 100, 100)),
    ((1, 0, 1), "purchase", (1, 0, 0), (0, None, 0), (0, None, 100)),
    ((0, 1, 1), "purchase", None, None, (None, 100, None)),
    ((0, 1, 0), "cart", None, None, (None, 0, None)),
    ((0, 0, 1), "purchase", None, None, (None, None, None)),
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [
        {"event_type": kind, "category_code": f"c{i}.x", "user_session": f"s{i}"}
        for i, (flags, *_) in enumerate(GOLDEN)
        for kind, flag in zip(STAGE_TYPES, flags, strict=True)
        if flag
    ]
    fact = fact_of(spark, *rows)

    def by_category(df):
        return {r.category_main: r for r in df.collect()}

    return by_category(fact), by_category(models.monthly_mart(fact)), by_category(models.daily_mart(fact))


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden_cases(golden, i):
    fact, monthly, daily = golden
    flags, stage, counts, monthly_rates, daily_rates = GOLDEN[i]
    name = f"c{i}"
    row = fact[name]
    assert (row.has_view, row.has_cart, row.has_purchase) == flags
    assert row.funnel_stage == stage
    rates = ("view_to_cart_rate", "cart_to_purchase_rate", "overall_conversion_rate")
    if counts is None:
        assert name not in monthly
    else:
        month = monthly[name]
        assert (month.view_count, month.cart_count, month.purchase_count) == counts
        assert tuple(month[r] for r in rates) == monthly_rates
    assert tuple(daily[name][r] for r in rates) == daily_rates


def test_schemas_match_the_contracts(spark):
    staged = models.staging(events(spark, {}))
    fact = models.funnel_fact(staged)
    for df, schema in (
        (staged, STAGING),
        (fact, FACT),
        (models.monthly_mart(fact), MONTHLY),
        (models.daily_mart(fact), DAILY),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_a_session_across_midnight_is_two_rows(spark):
    fact = fact_of(
        spark,
        {"event_time": "2019-10-01 23:59:00"},
        {"event_time": "2019-10-02 00:01:00", "event_type": "cart"},
    )
    assert {(r.event_date, r.funnel_stage) for r in fact.collect()} == {
        (dt.date(2019, 10, 1), "view"),
        (dt.date(2019, 10, 2), "cart"),
    }


def test_a_price_change_is_two_rows(spark):
    assert fact_of(spark, {"price": 1.0}, {"price": 2.0, "event_type": "cart"}).count() == 2


def test_repeated_events_are_one_row(spark):
    assert fact_of(spark, *[{}] * 5).count() == 1


def test_missing_brand_and_category_are_groups(spark):
    fact = fact_of(spark, {"brand": None}, {"category_code": None}, {"brand": None, "user_session": "s2"})
    cells = {(r.category_main, r.brand): r.view_count for r in models.monthly_mart(fact).collect()}
    assert cells == {("garden", None): 2, (None, "oakley"): 1}


@pytest.mark.parametrize(
    ("code", "main"), [("a.b.c", "a"), ("a", "a"), ("", ""), (None, None), (".a", "")]
)
def test_category_main(spark, code, main):
    assert models.staging(events(spark, {"category_code": code})).first().category_main == main


@pytest.mark.parametrize(
    "reject",
    [{"event_type": "signup"}, {"event_type": None}, {"user_id": None}, {"user_session": None}, {"product_id": None}],
)
def test_staging_rejects(spark, reject):
    assert models.staging(events(spark, reject, {})).count() == 1


def test_rates_round_to_two_decimals(spark):
    rows = [{"user_session": f"s{i}"} for i in range(3)] + [{"user_session": "s0", "event_type": "cart"}]
    assert models.monthly_mart(fact_of(spark, *rows)).first().view_to_cart_rate == 33.33


def test_rates_and_counts_are_bounded(spark):
    fact = models.funnel_fact(models.staging(event_log(spark, "/root/testdata/sf0.001")))
    monthly, daily = models.monthly_mart(fact), models.daily_mart(fact)
    for mart in (monthly, daily):
        rates = [c for c in mart.columns if c.endswith("_rate")]
        for rate in rates:
            assert mart.filter(~F.col(rate).between(0, 100)).count() == 0
    assert monthly.filter("purchase_count > cart_count or cart_count > view_count").count() == 0
    assert daily.filter("view_to_cart_sessions > least(view_sessions, cart_sessions)").count() == 0


def test_order(spark):
    rows = [
        {"event_time": "2019-10-02 00:00:00"},
        {"category_code": "a", "event_type": "cart"},
        {"category_code": "b"},
        {"category_code": "c"},
        {"category_code": "c", "event_type": "purchase"},
    ]
    daily = models.daily_in_order(models.daily_mart(fact_of(spark, *rows))).collect()
    assert [(r.event_date.day, r.category_main) for r in daily] == [
        (1, "c"),
        (1, "b"),
        (1, "a"),
        (2, "garden"),
    ]
