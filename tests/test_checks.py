from __future__ import annotations

import pytest

from shopfunnel.operators import checks
from shopfunnel.plans import models
from shopfunnel.schemas import DAILY, FACT, ContractError, assert_contract, conform, contract_breaches
from tests.rows import events


def test_counts_per_check(spark):
    df = spark.createDataFrame([("view", 1), ("cart", None), ("x", None), (None, 2)], "kind string, n int")
    found = checks.check(df, "m", (checks.AcceptedValues("kind", ("view", "cart")), checks.NotNull("n")))
    assert [tuple(r) for r in found.collect()] == [("m", "kind", "accepted_values", 1), ("m", "n", "not_null", 2)]


def test_failing_checks_raise_together(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    good = checks.check(df, "good", (checks.NotNull("b"),))
    assert checks.enforce([good]) == [("good", "b", "not_null", 0)]
    with pytest.raises(checks.CheckFailure, match="bad.a not_null: 1"):
        checks.enforce([good, checks.check(df, "bad", (checks.NotNull("a"),))])


def test_contract_names_the_differences(spark):
    daily = models.daily_mart(models.funnel_fact(models.staging(events(spark, {}))))
    assert assert_contract(daily, DAILY, "daily") is daily
    drifted = daily.drop("brand").withColumn("view_sessions", daily.view_sessions.cast("int"))
    assert contract_breaches(drifted.schema, DAILY) == [
        "brand: declared string, found absent",
        "view_sessions: declared bigint, found int",
    ]
    with pytest.raises(ContractError, match="view_sessions"):
        assert_contract(drifted, DAILY, "daily")
    rows = checks.check(drifted, "daily", (), DAILY).collect()
    assert [(r.check_name, r.failures) for r in rows] == [("contract", 2)]


def test_conform_orders_and_casts(spark):
    fact = models.funnel_fact(models.staging(events(spark, {})))
    shuffled = fact.select(*reversed(fact.columns)).withColumn("has_view", fact.has_view.cast("int"))
    assert conform(shuffled, FACT).schema == FACT
