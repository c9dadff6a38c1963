"""The report queries over the fact table and the marts.

Rates are always computed from summed counts; averaging the marts' rates would weigh a
cell of ten views like one of ten million.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfunnel.functions.events import rate
from shopfunnel.operators.reshape import rows_of
from shopfunnel.plans.models import with_daily_rates, with_monthly_rates
from shopfunnel.schemas import STAGES

MONTHLY_COUNTS = ("view_count", "cart_count", "purchase_count")
DAILY_COUNTS = (
    "view_sessions",
    "view_to_cart_sessions",
    "cart_sessions",
    "cart_to_purchase_sessions",
    "view_to_purchase_sessions",
)


def monthly_rates(monthly: DataFrame) -> DataFrame:
    """The three rates over time."""
    return rates_by(monthly, "event_month").orderBy("event_month")


def rates_by(monthly: DataFrame, *dimensions: str) -> DataFrame:
    """The monthly mart's counts and rates by any of its dimensions."""
    summed = monthly.groupBy(*dimensions).agg(*[F.sum(c).alias(c) for c in MONTHLY_COUNTS])
    return with_monthly_rates(summed)


def daily_trend(daily: DataFrame) -> DataFrame:
    """The three rates per day."""
    summed = daily.groupBy("event_date").agg(*[F.sum(c).alias(c) for c in DAILY_COUNTS])
    rates = with_daily_rates(summed)
    return rates.drop(*DAILY_COUNTS).orderBy("event_date")


def daily_volume(daily: DataFrame) -> DataFrame:
    """View and cart sessions per day."""
    volume = daily.groupBy("event_date").agg(*[F.sum(c).alias(c) for c in ("view_sessions", "cart_sessions")])
    return volume.orderBy("event_date")


def stage_distribution(fact: DataFrame) -> DataFrame:
    """Fact rows per furthest stage and their share in percent, stages in funnel order."""
    wide = fact.agg(
        F.count("funnel_stage").alias("total"),
        *[F.count_if(F.col("funnel_stage") == s).alias(s) for s in STAGES],
    )
    share = [rate(s, "total") for s in STAGES]
    return rows_of(
        wide,
        [
            {"funnel_stage": F.lit(s), "fact_rows": F.col(s), "share": pct}
            for s, pct in zip(STAGES, share, strict=True)
        ],
    )


def category_stages(fact: DataFrame) -> DataFrame:
    """Fact rows of each category by furthest stage, one column per stage."""
    counts = fact.groupBy("category_main").pivot("funnel_stage", list(STAGES)).agg(F.count(F.lit(1)))
    return counts.na.fill(0, list(STAGES)).orderBy("category_main")


def stage_detail(fact: DataFrame) -> DataFrame:
    """Fact rows per category and furthest stage, and their share of the category in percent."""
    counts = fact.groupBy("category_main", "funnel_stage").agg(F.count(F.lit(1)).alias("fact_rows"))
    # One row per stage in each window.
    whole = F.sum("fact_rows").over(Window.partitionBy("category_main"))
    return counts.withColumn("share", rate(F.col("fact_rows"), whole)).orderBy("category_main", "funnel_stage")


def event_type_by_hour(events: DataFrame) -> DataFrame:
    """Events per hour of day and type."""
    return (
        events.groupBy(F.hour("event_time").alias("hour"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("hour", "event_type")
    )
