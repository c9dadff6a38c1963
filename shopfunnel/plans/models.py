"""The four models: staging view, funnel fact, monthly and daily conversion marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.functions import events as E
from shopfunnel.schemas import DAILY, FACT, MONTHLY, STAGES, STAGING, conform

#: One fact row per combination; finer than session and product, since a session that
#: crosses midnight or sees a price change has several.
FACT_GRAIN = (
    "user_id",
    "user_session",
    "product_id",
    "category_main",
    "brand",
    "price",
    "event_date",
    "event_month",
    "event_month_date",
)


def staging(events: DataFrame) -> DataFrame:
    """Funnel events with all identifiers, and the top-level category."""
    kept = events.filter(E.is_funnel_event())
    return conform(kept.withColumn("category_main", E.category_main(F.col("category_code"))), STAGING)


def funnel_fact(staged: DataFrame) -> DataFrame:
    """Which stages each user reached for each product in each session.

    The month columns stay in the key although the day implies them: a filter on the
    month then still passes through the aggregate and prunes partitions. Repeated events
    meet in the map-side aggregate.
    """
    flags = staged.groupBy(*FACT_GRAIN).agg(*[E.reached(stage) for stage in STAGES])
    return conform(flags.withColumn("funnel_stage", E.furthest_stage()), FACT)


def monthly_mart(fact: DataFrame) -> DataFrame:
    """Monthly conversion by category and brand, over fact rows with a view.

    A cart counts if there was a view, a purchase if there were both.
    """
    viewed, carted, bought = _flags()
    counts = (
        fact.groupBy("event_month", "event_month_date", "category_main", "brand")
        .agg(
            F.count_if(viewed).alias("view_count"),
            F.count_if(viewed & carted).alias("cart_count"),
            F.count_if(viewed & carted & bought).alias("purchase_count"),
        )
        .filter(F.col("view_count") > 0)
    )
    return conform(with_monthly_rates(counts), MONTHLY)


def with_monthly_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "view_to_cart_rate": E.rate("cart_count", "view_count"),
            "cart_to_purchase_rate": E.rate("purchase_count", "cart_count"),
            "overall_conversion_rate": E.rate("purchase_count", "view_count"),
        }
    )


def daily_mart(fact: DataFrame) -> DataFrame:
    """Daily conversion by category and brand.

    Unlike the monthly mart each rate has its own population: a purchase needs a cart
    for the cart rate and a view for the overall rate, and cells without views stay,
    their rates NULL. "Sessions" are fact rows.
    """
    viewed, carted, bought = _flags()
    counts = fact.groupBy("event_date", "event_month", "event_month_date", "category_main", "brand").agg(
        F.count_if(viewed).alias("view_sessions"),
        F.count_if(viewed & carted).alias("view_to_cart_sessions"),
        F.count_if(carted).alias("cart_sessions"),
        F.count_if(carted & bought).alias("cart_to_purchase_sessions"),
        F.count_if(viewed & bought).alias("view_to_purchase_sessions"),
    )
    return conform(with_daily_rates(counts), DAILY)


def with_daily_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "view_to_cart_rate": E.rate("view_to_cart_sessions", "view_sessions"),
            "cart_to_purchase_rate": E.rate("cart_to_purchase_sessions", "cart_sessions"),
            "overall_conversion_rate": E.rate("view_to_purchase_sessions", "view_sessions"),
        }
    )


def monthly_in_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy("event_month_date", F.desc("overall_conversion_rate"))


def daily_in_order(mart: DataFrame) -> DataFrame:
    return mart.orderBy("event_date", F.desc("overall_conversion_rate"))


def _flags():
    return tuple(F.col(f"has_{stage}") == 1 for stage in STAGES)
