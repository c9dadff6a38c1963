from __future__ import annotations

from datetime import date

from shopfunnel.plans import behaviour, models, reports
from tests.rows import events


def views(category, sessions, carts=0, **more):
    row = {"category_code": category, **more}
    made = [{**row, "user_session": f"{category}{i}"} for i in range(sessions)]
    return made + [{**row, "user_session": f"{category}{i}", "event_type": "cart"} for i in range(carts)]


def staged_of(spark, *rows):
    return models.staging(events(spark, *rows))


def test_rates_come_from_sums_not_from_rates(spark):
    fact = models.funnel_fact(staged_of(spark, *views("a", 9), *views("b", 1, carts=1)))
    row = reports.monthly_rates(models.monthly_mart(fact)).first()
    assert (row.view_count, row.cart_count, row.view_to_cart_rate) == (10, 1, 10.0)
    day = reports.daily_trend(models.daily_mart(fact)).first()
    assert day.view_to_cart_rate == 10.0
    by_brand = reports.rates_by(models.monthly_mart(fact), "brand").first()
    assert by_brand.view_to_cart_rate == 10.0


def test_stage_distribution(spark):
    fact = models.funnel_fact(staged_of(spark, *views("a", 4, carts=1)))
    rows = [tuple(r) for r in reports.stage_distribution(fact).collect()]
    assert rows == [("view", 3, 75.0), ("cart", 1, 25.0), ("purchase", 0, 0.0)]


def test_category_stages(spark):
    fact = models.funnel_fact(staged_of(spark, *views("a", 2, carts=1), *views(None, 1)))
    rows = [tuple(r) for r in reports.category_stages(fact).collect()]
    assert rows == [(None, 1, 0, 0), ("a", 1, 1, 0)]


def test_stage_detail(spark):
    fact = models.funnel_fact(staged_of(spark, *views("a", 4, carts=1), *views(None, 1)))
    rows = [tuple(r) for r in reports.stage_detail(fact).collect()]
    assert rows == [(None, "view", 1, 100.0), ("a", "cart", 1, 25.0), ("a", "view", 3, 75.0)]


def test_event_type_by_hour(spark):
    rows = reports.event_type_by_hour(events(spark, {}, {"event_time": "2019-10-05 12:59:59"})).collect()
    assert [tuple(r) for r in rows] == [(12, "view", 2)]


def test_session_length(spark):
    staged = staged_of(spark, {}, {"event_time": "2019-10-01 12:01:30"})
    assert tuple(behaviour.session_lengths(staged).first()) == ("b2-77", 2, 90)


def test_views_before_purchase(spark):
    at = "2019-10-01 12:0{}:00".format
    staged = staged_of(
        spark,
        {"event_time": at(0)},
        {"event_time": at(1)},
        {"event_time": at(2), "event_type": "purchase"},
        {"event_time": at(3)},
        {"event_time": at(4), "event_type": "purchase"},
        {"event_time": at(0), "user_id": 2, "event_type": "purchase"},
        {"event_time": at(0), "user_id": 3},
        {"event_time": at(0), "product_id": 5, "category_code": None, "event_type": "purchase"},
    )
    rows = {tuple(r) for r in behaviour.views_before_purchase(staged).collect()}
    assert rows == {("garden", 2, 2, 1.0), (None, 1, 0, 0.0)}


def test_repeat_purchasers(spark):
    bought = {"event_type": "purchase"}
    staged = staged_of(
        spark,
        bought,
        {**bought, "product_id": 2},
        {**bought, "user_session": "s2"},
        {**bought, "user_id": 2},
        {**bought, "user_id": 2, "price": 3.0},
    )
    assert [tuple(r) for r in behaviour.repeat_purchasers(staged).collect()] == [(417, 2, 3)]


def test_top_breaks_ties_by_value(spark):
    staged = staged_of(spark, {"product_id": 3}, {"product_id": 2}, {"product_id": 1}, {"product_id": 1})
    assert [r.product_id for r in behaviour.top_by(staged, "product_id", 2).collect()] == [1, 2]


def test_brand_revenue(spark):
    staged = staged_of(spark, {}, {"event_type": "purchase", "price": 1.25}, {"brand": None})
    assert {tuple(r) for r in behaviour.brand_revenue(staged).collect()} == {("oakley", 1, 1, 1.25), (None, 1, 0, 0.0)}


def test_cart_abandonment(spark):
    cart = {"event_type": "cart"}
    fact = models.funnel_fact(
        staged_of(spark, cart, {**cart, "user_session": "s2"}, {"user_session": "s2", "event_type": "purchase"}, {})
    )
    row = behaviour.cart_abandonment(fact).first()
    assert (row.fact_rows, row.carted, row.bought, row.abandoned, row.abandonment_rate) == (2, 2, 1, 1, 50.0)


def test_peaks_and_weekdays(spark):
    staged = staged_of(spark, {}, {}, {"event_time": "2019-10-02 13:00:00"})
    assert {tuple(r) for r in behaviour.hourly_peaks(staged).collect()} == {("view", 12, 2, 1), ("view", 13, 1, 2)}
    # 2019-10-01 was a Tuesday.
    assert {tuple(r) for r in behaviour.weekday_traffic(staged).collect()} == {("view", 2, 2, 1), ("view", 3, 1, 2)}


def test_daily_change_skips_gaps(spark):
    days = ["2019-10-01", "2019-10-02", "2019-10-02", "2019-10-04"]
    staged = staged_of(spark, *[{"event_time": f"{d} 00:00:00"} for d in days])
    found = {r.event_date.day: r.change for r in behaviour.daily_change(staged).collect()}
    assert found == {1: None, 2: 1, 4: None}


def test_user_segments(spark):
    bought = {"event_type": "purchase"}
    fact = models.funnel_fact(
        staged_of(
            spark,
            {"user_id": 1},
            {"user_id": 2},
            {"user_id": 2, "event_type": "cart", "user_session": "s2"},
            {**bought, "user_id": 3},
            {**bought, "user_id": 3, "product_id": 9},
            {**bought, "user_id": 4},
            {**bought, "user_id": 4, "user_session": "s2"},
            {**bought, "user_id": 5},
        )
    )
    found = {tuple(r) for r in behaviour.user_segments(fact).collect()}
    assert found == {("view only", 1), ("cart only", 1), ("buyer", 2), ("repeat buyer", 1)}


def test_retention(spark):
    staged = staged_of(
        spark,
        {},
        {"event_time": "2019-11-05 00:00:00"},
        {"event_time": "2019-11-06 00:00:00"},
        {"event_time": "2019-11-06 00:00:00", "user_id": 2},
    )
    october, november = date(2019, 10, 1), date(2019, 11, 1)
    assert {tuple(r) for r in behaviour.retention(staged).collect()} == {
        (october, october, 1),
        (october, november, 1),
        (november, november, 1),
    }
