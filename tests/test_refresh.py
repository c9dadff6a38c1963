from __future__ import annotations

import pytest

from shopfunnel.operators import layout, versions
from shopfunnel.operators.checks import CheckFailure
from shopfunnel.plans import models, refresh, warehouse
from shopfunnel.schemas import ContractError
from shopfunnel.sources.tables import read_events, refresh_external
from tests.rows import events

MONTHS = [
    {"event_time": f"2019-{m}-{d:02} 10:00:00", "event_type": t, "user_id": d, "brand": b}
    for m in (10, 11)
    for d in (1, 2, 3)
    for t, b in (("view", "oakley"), ("cart", "oakley"), ("view", None), ("purchase", "x"))
]
RELOAD = [{"event_time": "2019-10-02 10:00:00", "event_type": t} for t in ("view", "purchase")]


def rows(df):
    names = sorted(df.columns)
    return sorted(str(tuple(r)) for r in df.select(names).collect())


def files(spark, database):
    return {t: set(spark.table(f"{database}.{t}").filter("event_month = '2019-11'").inputFiles()) for t in refresh.TABLES}


@pytest.fixture(params=["plain", "published"])
def built(spark, tmp_path, request):
    """A dataset of two months and a database refreshed from it."""
    root = str(tmp_path / "events")
    if request.param == "plain":
        layout.append_events(events(spark, *MONTHS), root)
    else:
        for month in ("2019-10", "2019-11"):
            versions.replace_month(events(spark, *MONTHS), root, month)
    spark.sql("CREATE DATABASE refreshed")
    refresh.refresh(spark, root, "refreshed")
    yield root
    spark.sql("DROP DATABASE refreshed CASCADE")


def equals_full_build(spark, root):
    """Every table holds what the models make of the dataset as it is now."""
    log = read_events(spark, root)
    staged = models.staging(log)
    fact = models.funnel_fact(staged)
    expected = {
        warehouse.PARTITIONED: log, warehouse.CLUSTERED: log, warehouse.FACT_TABLE: fact,
        warehouse.MONTHLY_TABLE: models.monthly_mart(fact), warehouse.DAILY_TABLE: models.daily_mart(fact),
    }
    for table, df in expected.items():
        assert rows(spark.table(f"refreshed.{table}").select(*df.columns)) == rows(df), table


def test_a_refreshed_month_equals_a_full_build(spark, built):
    equals_full_build(spark, built)
    before = files(spark, "refreshed")
    for delivery in (RELOAD, RELOAD, RELOAD[:1]):
        layout.replace_month(events(spark, *delivery), built, "2019-10")
        refresh.refresh(spark, built, "refreshed", ["2019-10"])
        equals_full_build(spark, built)
    assert files(spark, "refreshed") == before  # the other month was not written
    days = spark.table(f"refreshed.{warehouse.CLUSTERED}").filter("event_month = '2019-10'").select("event_date").distinct()
    assert [str(r.event_date) for r in days.collect()] == ["2019-10-02"]
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS refreshed.{warehouse.CLUSTERED}").collect()][0].endswith("10-02")


def test_a_refresh_reads_its_month_only(spark, built):
    for table in (warehouse.EXTERNAL, *refresh.TABLES):
        read = refresh.of_month(spark, "refreshed", table, "2019-10").inputFiles()
        assert read and all("event_month=2019-10" in f for f in read), table
    staged = models.staging(refresh.of_month(spark, "refreshed", warehouse.CLUSTERED, "2019-10"))
    assert all("event_month=2019-10" in f for f in models.funnel_fact(staged).inputFiles())


def test_a_month_that_was_emptied(spark, built):
    layout.replace_month(events(spark, *MONTHS).limit(0), built, "2019-10")
    refresh.refresh(spark, built, "refreshed", ["2019-10"])
    equals_full_build(spark, built)
    assert spark.table(f"refreshed.{warehouse.DAILY_TABLE}").select("event_month").distinct().count() == 1


def test_a_new_month(spark, built):
    layout.replace_month(events(spark, {"event_time": "2019-12-01 10:00:00"}), built, "2019-12")
    refresh.refresh(spark, built, "refreshed", ["2019-12"])
    equals_full_build(spark, built)


def test_checks_of_one_month_are_run_and_all_are_merged(spark, built, monkeypatch):
    once = rows(refresh.merged_checks(spark, "refreshed"))
    assert len(once) == 4 + 3 + 1 + 4
    ran = []
    monkeypatch.setattr(refresh, "check_models", lambda *tables: ran.append(tables) or warehouse.check_models(*tables))
    results = refresh.refresh(spark, built, "refreshed", ["2019-10"])
    assert len(ran) == 1 and len(results) == len(once) and not any(n for *_, n in results)
    spark.sql(
        f"INSERT INTO refreshed.{refresh.CHECKS_TABLE} "
        "SELECT 'staged_events', 'user_id', 'not_null', 2L, '2019-11'"
    )
    with pytest.raises(CheckFailure, match="user_id not_null: 2"):
        refresh.refresh(spark, built, "refreshed", ["2019-10"])
    refresh.refresh(spark, built, "refreshed", ["2019-11"])


def test_a_broken_contract_is_not_written(spark, built, monkeypatch):
    before = rows(spark.table(f"refreshed.{warehouse.FACT_TABLE}"))
    monkeypatch.setattr(models, "funnel_fact", lambda staged: staged)
    with pytest.raises(ContractError):
        refresh.refresh(spark, built, "refreshed", ["2019-10"])
    assert rows(spark.table(f"refreshed.{warehouse.FACT_TABLE}")) == before


def test_refreshing_partitions_twice_changes_nothing(spark, built):
    for _ in range(2):
        refresh_external(spark, f"refreshed.{warehouse.EXTERNAL}", built)
        assert spark.table(f"refreshed.{warehouse.EXTERNAL}").count() == len(MONTHS)
