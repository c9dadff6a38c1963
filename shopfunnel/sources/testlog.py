"""An event log derived from the test tables ``events`` and ``part``.

Each test event becomes an event about one product. A few neighbouring users share five
products, so the stages of one product meet in one session, and the number of products
grows with the number of users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.functions.events import TIME_FORMAT, TIME_SUFFIX
from shopfunnel.operators.gate import with_partition_columns
from shopfunnel.schemas import BRONZE, PROCESSED, conform

# Values of ``k`` whose events get a raw value that does not convert, by column.
BAD = {
    "event_time": (11,),
    "product_id": (7, 29),
    "category_id": (23,),
    "price": (13, 29, 47),
    "user_id": (17,),
}
# Values of ``k`` whose events lack a raw value, by column.
LACKING = {"event_time": (37,), "product_id": (41,), "price": (43,), "user_id": (31, 47)}


# Fixed types of the columns used.
EVENTS_TABLE = "ts timestamp_ntz, user_id bigint, event_type string, props string"
PART_TABLE = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_TABLE).parquet(f"{sf_dir}/events.parquet")
    parts = spark.read.schema(PART_TABLE).parquet(f"{sf_dir}/part.parquet")
    k = F.regexp_extract("props", '"k": *([0-9]+)', 1).try_cast("bigint")
    keyed = events.withColumn("k", k).withColumn(
        "product_id", F.expr("user_id div 3") * 5 + F.col("k") % 5
    )
    return keyed.join(parts, keyed.product_id == parts.p_partkey, "left")


def _log_columns() -> dict[str, Column]:
    kind = F.lower("p_type")
    noun = F.substring_index("p_name", " ", -1)
    size = F.col("p_size")
    time = F.date_trunc("second", F.col("ts").cast("timestamp"))
    session = F.concat_ws("-", "user_id", F.date_format(time, "yyyy-MM-dd"))
    return {
        "event_time": time,
        "event_type": F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")),
        "product_id": F.col("product_id"),
        "category_id": 1000 + size.cast("bigint"),
        "category_code": F.when(size > 15, F.concat_ws(".", kind, noun)),
        "brand": F.when((size > 4) & ~size.between(16, 18), F.col("p_brand")),
        "price": F.col("p_retailprice"),
        "user_id": F.col("user_id"),
        "user_session": F.when(F.col("k") != 99, session),
    }


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as processed rows with their partition columns."""
    log = _tables(spark, sf_dir).select(*[e.alias(c) for c, e in _log_columns().items()])
    return with_partition_columns(conform(log, PROCESSED))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as raw text, with bad and absent values in every gated column."""
    log = _tables(spark, sf_dir).select("k", *[e.alias(c) for c, e in _log_columns().items()])
    text = {c: F.col(c).cast("string") for c in PROCESSED.names}
    text["event_time"] = F.concat(F.date_format("event_time", TIME_FORMAT), F.lit(TIME_SUFFIX))
    text["price"] = F.col("price").cast("decimal(18,2)").cast("string")
    for column, ks in BAD.items():
        text[column] = F.when(F.col("k").isin(*ks), f"bad_{column}").otherwise(text[column])
    for column, ks in LACKING.items():
        text[column] = F.when(~F.col("k").isin(*ks), text[column])
    return log.select(*[text[c].alias(c) for c in BRONZE.names])
