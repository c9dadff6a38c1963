"""Sinks: partitioned Parquet, month replacement, quarantine, warehouse tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.operators import versions
from shopfunnel.operators.clustering import interleaved
from shopfunnel.operators.files import by_day, write_by_day
from shopfunnel.schemas import EVENTS
from shopfunnel.sources.versions import is_versioned


def append_events(events: DataFrame, root: str) -> None:
    """Add rows to the dataset, each under the month and day of its own time."""
    if is_versioned(events.sparkSession, root):
        versions.append_batch(events, root, uuid.uuid4().hex)
    else:
        write_by_day(events, root, "append", "event_month", "event_date")


def overwrite_events(events: DataFrame, root: str) -> None:
    """Replace the whole dataset."""
    write_by_day(events, root, "overwrite", "event_month", "event_date")


def replace_month(events: DataFrame, root: str, month: str) -> None:
    """Make the dataset's ``month`` hold exactly the given rows of that month.

    Writing to the month's own folder in static mode removes days that the new load no
    longer has and leaves other months alone; loading again changes nothing. Rows of
    other months are not written: see :func:`misfiled`. As with any plain file layout
    the swap is not atomic: an aborted load is put right by running it again. Datasets
    with published versions are replaced by :func:`versions.replace_month`, which is.
    """
    if is_versioned(events.sparkSession, root):
        versions.replace_month(events, root, month)
        return
    rows = events.filter(F.col("event_month") == month).drop("event_month")
    write_by_day(rows, f"{root.rstrip('/')}/event_month={month}", "overwrite", "event_date")


def astray(month_of_row: Column, month: str) -> Column:
    """Whether a row's own month is not the one it was delivered for."""
    return month_of_row != month


def misfiled(events: DataFrame, month: str) -> DataFrame:
    """Rows whose own time lies outside the month they were delivered for."""
    return events.filter(astray(F.col("event_month"), month))


def replace_month_in_table(events: DataFrame, table: str, month: str) -> None:
    """:func:`replace_month` for a catalog table partitioned by month and day."""
    spark = events.sparkSession
    columns = [c for c in spark.table(table).columns if c not in ("event_month", "event_date")]
    rows = by_day(events.filter(F.col("event_month") == month)).select(*columns, "event_date")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        spark.sql(
            "INSERT OVERWRITE IDENTIFIER(:name) PARTITION (event_month = :month, event_date) "
            "SELECT * FROM {rows}",
            args={"name": table, "month": month},
            rows=rows,
        )
    finally:
        spark.conf.set(key, before)


def write_quarantine(rows: DataFrame, root: str, month: str, failures: int) -> bool:
    """Replace the quarantine of ``month``; tells whether anything was written.

    Quarantines of other months stay. Without failures nothing is written, unless an
    earlier load of the month left rows that no longer apply.
    """
    path = f"{root.rstrip('/')}/event_month={month}"
    if failures == 0 and not _exists(rows.sparkSession, path):
        return False
    few_files = rows.hint("rebalance")  # failures are scattered over all tasks of the load
    few_files.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return True


def partitioned_table(events: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create or replace a table of all event columns, partitioned by day."""
    return _save_table(by_day(events.select(*EVENTS.names)), table, path)


def clustered_table(
    events: DataFrame,
    table: str,
    cluster_by: Sequence[str] = ("event_type",),
    path: str | None = None,
    interleave: bool = False,
) -> DataFrame:
    """:func:`partitioned_table` with each file sorted by the cluster columns.

    A filter on the first of them then skips row groups by their min/max; with ``interleave``
    a filter on any does, and whole files too.
    """
    return _save_table(clustered(events.select(*EVENTS.names), cluster_by, interleave), table, path)


def clustered(events: DataFrame, cluster_by: Sequence[str], interleave: bool = False) -> DataFrame:
    """Rows dealt over tasks and sorted as a clustered table is written.

    The partition column has to lead the sort: the writer wants rows by day and would sort
    them again otherwise.
    """
    if interleave:
        return interleaved(events, cluster_by, leading=("event_date",))
    return by_day(events).sortWithinPartitions("event_date", *cluster_by)


def model_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create or replace a model's table."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def _save_table(rows: DataFrame, table: str, path: str | None) -> DataFrame:
    writer = rows.write.mode("overwrite").format("parquet").partitionBy("event_date")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return rows.sparkSession.table(table)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
