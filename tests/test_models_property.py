"""The models against a plain reading of their definitions, on arbitrary small logs."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopfunnel.operators.gate import with_partition_columns
from shopfunnel.plans import behaviour, models
from shopfunnel.schemas import PROCESSED

EVENT = st.fixed_dictionaries(
    {
        "event_time": st.builds(
            datetime,
            st.just(2019),
            st.sampled_from([10, 11]),
            st.integers(1, 2),
            st.sampled_from([0, 23]),
            st.just(0),
            st.integers(0, 3),
        ),
        "event_type": st.sampled_from(["view", "view", "cart", "purchase", "purchase", "signup", None]),
        "product_id": st.sampled_from([1, 2, None]),
        "category_id": st.just(1),
        "category_code": st.sampled_from(["a.x", "a.y", "b", None]),
        "brand": st.sampled_from(["p", None]),
        "price": st.sampled_from([1.0, 2.5, None]),
        "user_id": st.sampled_from([1, 2, None]),
        "user_session": st.sampled_from(["s", "t", None]),
    }
)


def percent(part, whole):
    return None if whole == 0 else round(part / whole * 100, 2)


def plain_fact(log):
    groups = defaultdict(set)
    for e in log:
        ids = (e["user_id"], e["user_session"], e["product_id"])
        if e["event_type"] in ("view", "cart", "purchase") and None not in ids:
            main = e["category_code"] and e["category_code"].split(".")[0]
            day = e["event_time"].date()
            groups[(*ids, main, e["brand"], e["price"], day)].add(e["event_type"])
    return groups


def plain_marts(fact):
    months, days = defaultdict(lambda: [0] * 3), defaultdict(lambda: [0] * 5)
    for (*_, main, brand, _price, day), kinds in fact.items():
        v, c, p = (k in kinds for k in ("view", "cart", "purchase"))
        for i, hit in enumerate((v, v and c, v and c and p)):
            months[(date(day.year, day.month, 1), main, brand)][i] += hit
        for i, hit in enumerate((v, v and c, c, c and p, v and p)):
            days[(day, main, brand)][i] += hit
    monthly = {
        (*key, v, c, p, percent(c, v), percent(p, c), percent(p, v)) for key, (v, c, p) in months.items() if v
    }
    daily = {
        (*key, v, vc, c, cp, vp, percent(vc, v), percent(cp, c), percent(vp, v))
        for key, (v, vc, c, cp, vp) in days.items()
    }
    return monthly, daily


def plain_views_before(log):
    by_pair = defaultdict(list)
    for e in log:
        if plain_fact([e]):
            by_pair[e["user_id"], e["product_id"]].append(e)
    found = defaultdict(lambda: [0, 0])
    for events in by_pair.values():
        bought = [e for e in events if e["event_type"] == "purchase"]
        if bought:
            first = min(e["event_time"] for e in bought)
            mains = [e["category_code"].split(".")[0] for e in bought if e["category_code"]]
            cell = found[min(mains, default=None)]
            cell[0] += 1
            cell[1] += sum(e["event_type"] == "view" and e["event_time"] < first for e in events)
    return {(main, n, views, round(views / n, 4)) for main, (n, views) in found.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EVENT, min_size=1, max_size=120))
def test_models_follow_their_definitions(spark, log):
    rows = spark.createDataFrame([tuple(e[c] for c in PROCESSED.names) for e in log], PROCESSED)
    staged = models.staging(with_partition_columns(rows))
    fact = models.funnel_fact(staged)
    expected = plain_fact(log)
    stages = ("purchase", "cart", "view")
    assert {tuple(r)[:7]: r.funnel_stage for r in fact.collect()} == {
        key: next(s for s in stages if s in kinds) for key, kinds in expected.items()
    }
    monthly, daily = plain_marts(expected)
    assert {tuple(r)[1:] for r in models.monthly_mart(fact).collect()} == monthly
    assert {(r.event_date, *tuple(r)[3:]) for r in models.daily_mart(fact).collect()} == daily
    assert {tuple(r) for r in behaviour.views_before_purchase(staged).collect()} == plain_views_before(log)
