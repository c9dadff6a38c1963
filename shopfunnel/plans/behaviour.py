"""User, product and time questions the event log is meant to answer.

The questions are given without definitions; those here are this library's own and each
function states its one. All take staged events or the funnel fact.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfunnel.functions.events import rate
from shopfunnel.schemas import STAGES


def session_lengths(staged: DataFrame) -> DataFrame:
    """Events and seconds between the first and the last event of each session."""
    return staged.groupBy("user_session").agg(
        F.count(F.lit(1)).alias("events"),
        (F.unix_timestamp(F.max("event_time")) - F.unix_timestamp(F.min("event_time"))).alias("seconds"),
    )


def views_before_purchase(staged: DataFrame) -> DataFrame:
    """Per category: users' products bought, and the mean number of views before the first purchase.

    Purchases are few: they are merged by user and product first, and views meet them in one
    shuffle, or in none where Spark finds the pairs small enough to broadcast. Views of products
    the user never bought end there. Compared null-safely, the pairs don't count as laid out by the
    join's keys yet and are shuffled once more. Both sides of the join are shuffle stages then, and
    AQE splits the views of a user who hammers one product over several tasks, which it does not
    where one side is an aggregate.
    """
    pair = ["user_id", "product_id"]
    kind, bought = F.col("event_type"), F.col("category").alias("category_main")
    pairs = (
        staged.filter(kind == "purchase")
        .groupBy(*pair)
        .agg(F.min("event_time").alias("bought_at"), F.min("category_main").alias("category"))
    )
    views = staged.filter(kind == "view").select(*pair, "event_time")
    same_pair = reduce(and_, [views[c].eqNullSafe(pairs[c]) for c in pair])
    before = views.join(pairs, same_pair).filter("event_time < bought_at")
    return (
        pairs.select(bought, F.lit(1).alias("product"), F.lit(0).alias("view"))
        .unionAll(before.select(bought, F.lit(0), F.lit(1)))
        .groupBy("category_main")
        .agg(F.sum("product").alias("products_bought"), F.sum("view").alias("views_before"))
        .withColumn("mean_views", F.round(F.try_divide("views_before", "products_bought"), 4))
    )


def repeat_purchasers(staged: DataFrame) -> DataFrame:
    """Users who bought in more than one session, with the sessions and purchases."""
    return (
        staged.filter(F.col("event_type") == "purchase")
        .groupBy("user_id", "user_session")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("purchase_sessions"), F.sum("n").alias("purchases"))
        .filter(F.col("purchase_sessions") > 1)
    )


def top_by(staged: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` values of ``column`` with most events; the smaller value first on a tie."""
    return (
        staged.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("events"), column)
        .limit(n)
    )


def brand_revenue(staged: DataFrame) -> DataFrame:
    """Views, purchases and revenue of each brand; revenue is the price over purchases."""
    bought = F.col("event_type") == "purchase"
    return staged.groupBy("brand").agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(bought).alias("purchases"),
        F.coalesce(F.round(F.sum(F.when(bought, F.col("price"))), 2), F.lit(0.0)).alias("revenue"),
    )


def cart_abandonment(fact: DataFrame) -> DataFrame:
    """Per product: fact rows with a cart, those left without a purchase, and the rates."""
    carted, bought = F.col("has_cart") == 1, F.col("has_purchase") == 1
    counts = fact.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(carted).alias("carted"),
        F.count_if(bought).alias("bought"),
        F.count_if(carted & ~bought).alias("abandoned"),
    )
    return counts.withColumns(
        {
            "cart_rate": rate("carted", "fact_rows"),
            "purchase_rate": rate("bought", "fact_rows"),
            "abandonment_rate": rate("abandoned", "carted"),
        }
    )


def hourly_peaks(staged: DataFrame) -> DataFrame:
    """Events per type and hour of day, ranked within the type; rank 1 is the peak."""
    return _ranked(staged, F.hour("event_time").alias("hour"))


def weekday_traffic(staged: DataFrame) -> DataFrame:
    """Events per type and weekday (1 is Monday), ranked within the type."""
    return _ranked(staged, (F.weekday("event_time") + 1).alias("weekday"))


def daily_change(staged: DataFrame) -> DataFrame:
    """Events per day and the change against the calendar day before, NULL without one."""
    days = staged.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))
    before = days.select(F.date_add("event_date", 1).alias("event_date"), F.col("events").alias("events_before"))
    return days.join(before, "event_date", "left").withColumn("change", F.col("events") - F.col("events_before"))


def user_segments(fact: DataFrame) -> DataFrame:
    """Users by the furthest stage they ever reached, buyers split by how many sessions they bought in.

    Users shuffle as one row per session, so a user with many fact rows weighs little.
    """
    flags = [f"has_{stage}" for stage in STAGES]
    sessions = fact.groupBy("user_id", "user_session").agg(*[F.max(c).alias(c) for c in flags])
    users = sessions.groupBy("user_id").agg(
        F.max("has_cart").alias("carted"), F.sum("has_purchase").alias("purchase_sessions")
    )
    segment = (
        F.when(F.col("purchase_sessions") > 1, "repeat buyer")
        .when(F.col("purchase_sessions") == 1, "buyer")
        .when(F.col("carted") == 1, "cart only")
        .otherwise("view only")
    )
    return users.groupBy(segment.alias("segment")).agg(F.count(F.lit(1)).alias("users"))


def retention(staged: DataFrame, period: str = "month") -> DataFrame:
    """Users by the period they were first seen in and the periods they came back in.

    ``period`` is a unit of ``date_trunc``. A user has one row per active period before
    the window, however many events they made.
    """
    active = staged.select("user_id", F.to_date(F.date_trunc(period, "event_time")).alias("active")).distinct()
    first = F.min("active").over(Window.partitionBy("user_id"))
    return (
        active.withColumn("cohort", first)
        .groupBy("cohort", "active")
        .agg(F.count(F.lit(1)).alias("users"))
    )


def _ranked(staged: DataFrame, slot) -> DataFrame:
    counts = staged.groupBy("event_type", slot).agg(F.count(F.lit(1)).alias("events"))
    # At most 24 rows per event type, of which staging lets three through.
    return counts.withColumn("rank", F.rank().over(Window.partitionBy("event_type").orderBy(F.desc("events"))))
