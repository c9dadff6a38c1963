"""Writing events by month and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_day(events: DataFrame) -> DataFrame:
    """Rows of one day brought together, so a day becomes a few files and not one per task.

    ``rebalance`` rather than ``repartition``: AQE splits a day that outgrows the
    advisory size over as many tasks as it needs and merges small ones.
    """
    return events.hint("rebalance", F.col("event_date"))


def write_by_day(events: DataFrame, path: str, mode: str, *keys: str) -> None:
    (
        by_day(events)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(path)
    )
