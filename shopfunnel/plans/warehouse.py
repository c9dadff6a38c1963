"""From the processed dataset to checked model tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shopfunnel.operators import checks, layout
from shopfunnel.plans import models
from shopfunnel.schemas import DAILY, FACT, MONTHLY, assert_contract
from shopfunnel.session import sized_shuffle
from shopfunnel.sources.tables import register_external, source, table_bytes

# Names of the tables, in the order they are built.
EXTERNAL = "events_external"
PARTITIONED = "events_partitioned"
CLUSTERED = "events_clustered"
STAGING_VIEW = "staged_events"
FACT_TABLE = "funnel_fact"
MONTHLY_TABLE = "funnel_monthly"
DAILY_TABLE = "funnel_daily"


def build_event_tables(
    spark: SparkSession,
    root: str,
    database: str = "default",
    cluster_by: Sequence[str] = ("event_type",),
    location: str | None = None,
) -> DataFrame:
    """The external table over ``root`` and its partitioned and clustered copies.

    ``location`` is a folder for the copies where the warehouse folder will not do.
    """
    external = register_external(spark, f"{database}.{EXTERNAL}", root)
    layout.partitioned_table(external, f"{database}.{PARTITIONED}", _under(location, PARTITIONED))
    return layout.clustered_table(external, f"{database}.{CLUSTERED}", cluster_by, _under(location, CLUSTERED))


def build_models(
    spark: SparkSession, database: str = "default", location: str | None = None
) -> list[tuple[str, str, str, int]]:
    """Staging view, fact and marts in order of dependency, then their checks.

    A model that breaks its contract is not written; a failed check raises after all
    models are. The marts read the fact's table, so it is aggregated once.
    """
    staged = models.staging(source(spark, f"{database}.{CLUSTERED}"))
    staged.createOrReplaceTempView(STAGING_VIEW)

    def build(df: DataFrame, contract: T.StructType, table: str) -> DataFrame:
        checked = assert_contract(df, contract, table)
        return layout.model_table(checked, f"{database}.{table}", _under(location, table))

    with sized_shuffle(spark, table_bytes(spark, f"{database}.{CLUSTERED}")):
        fact = build(models.funnel_fact(spark.table(STAGING_VIEW)), FACT, FACT_TABLE)
        monthly = build(models.monthly_mart(fact), MONTHLY, MONTHLY_TABLE)
        daily = build(models.daily_mart(fact), DAILY, DAILY_TABLE)
        return checks.enforce(check_models(staged, fact, monthly, daily))


def check_models(staged: DataFrame, fact: DataFrame, monthly: DataFrame, daily: DataFrame) -> list[DataFrame]:
    return [
        checks.check(staged, STAGING_VIEW, checks.STAGING_CHECKS),
        checks.check(fact, FACT_TABLE, checks.FACT_CHECKS, FACT),
        checks.check(monthly, MONTHLY_TABLE, (), MONTHLY),
        checks.check(daily, DAILY_TABLE, checks.DAILY_CHECKS, DAILY),
    ]


def _under(location: str | None, table: str) -> str | None:
    return f"{location.rstrip('/')}/{table}" if location else None
