"""Loading months of raw CSV into the processed dataset."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.functions import events as E
from shopfunnel.operators import gate, layout, versions
from shopfunnel.schemas import BRONZE, EVENTS, GATED
from shopfunnel.session import pin_utc, work_table
from shopfunnel.sources.csv import Paths, first_day, input_bytes, scan_bronze
from shopfunnel.sources.versions import CLEAN, FAILED, REPLACE, is_versioned

logger = logging.getLogger(__name__)

#: Reason given to a row delivered for another month than its own.
MISFILED = "event_month"


class LoadRefused(ValueError):
    """A delivery that would lose rows or empty a month."""


@dataclass(frozen=True)
class LoadMetrics:
    """Rows of one load. ``total = processed + dropped + misfiled``."""

    total: int
    cast_failed: int
    processed: int
    dropped: int
    misfiled: int

    @property
    def cast_failed_rate(self) -> float:
        return self.cast_failed / self.total if self.total else 0.0

    @property
    def processed_rate(self) -> float:
        return self.processed / self.total if self.total else 0.0

    def __str__(self) -> str:
        return (
            f"{self.total:,} rows, {self.cast_failed:,} cast failures ({self.cast_failed_rate:.4%}), "
            f"{self.processed:,} processed ({self.processed_rate:.2%}), {self.dropped:,} without a key, "
            f"{self.misfiled:,} of another month"
        )


def route(bronze: DataFrame, month: str) -> DataFrame:
    """Every raw row once, with where it goes.

    Holds the processed columns, ``keep`` (the row belongs to the month's processed
    rows), ``failure_reason``, and the raw values of rows that go to quarantine. A row
    of another month is quarantined for that reason: written to its own month it would be
    added again by every load of this one.
    """
    typed = gate.with_failure_reason(gate.with_typed(bronze))
    placed = F.date_format("event_time_typed", "yyyy-MM")
    astray = F.coalesce(E.has_keys() & layout.astray(placed, month), F.lit(False))
    typed = typed.withColumns({"keep": E.has_keys() & ~astray, "astray": astray})
    reason = F.nullif(F.concat_ws(", ", "failure_reason", F.when(F.col("astray"), F.lit(MISFILED))), F.lit(""))
    typed = typed.withColumn("failure_reason", reason)
    held = [
        F.when(F.col("failure_reason").isNotNull(), F.col(f"{c}_raw")).alias(f"{c}_raw") for c in GATED
    ]
    values = [F.col(f"{c}_typed").alias(c) if c in GATED else F.col(c) for c in BRONZE.names]
    return typed.select(*values, *held, "failure_reason", "keep", "astray", (~E.has_keys()).alias("lacks_key"))


def load_month(
    spark: SparkSession,
    paths: Paths,
    root: str,
    month: str,
    quarantine_root: str | None = None,
    may_empty: bool = False,
    versioned: bool = False,
) -> LoadMetrics:
    """Load the CSV files of one month; loading it again leaves the same rows.

    Raises :class:`LoadRefused` before anything is written if rows of other months came
    along and there is no quarantine to keep them, or if none of the rows delivered belongs
    to the month, unless it ``may_empty`` the month. A delivery without rows empties it.

    A ``versioned`` load publishes the month in one step: readers see the old rows or the new
    ones, also when it is aborted. It writes each row once, where it is to stay, and needs no
    work table. Once a dataset has a version, all later loads work so.

    The CSV is parsed once, into a work table the counts, the quarantine and the
    processed rows are then read from. Counting on the side of a write would be free but
    a task repeated after losing an executor counts its rows again.
    """
    first_day(month)
    pin_utc(spark)
    logger.info("loading %s, %s bytes, from %s", month, f"{input_bytes(spark, paths):,}", paths)
    if versioned or is_versioned(spark, root):
        return _load_published(spark, scan_bronze(spark, paths), root, month, quarantine_root, may_empty)
    with work_table(route(scan_bronze(spark, paths), month), f"routed-{month}") as routed:
        metrics = _metrics(routed)
        logger.info("%s", metrics)
        _assert_safe(metrics, month, quarantine_root is not None, may_empty)
        if quarantine_root:
            failed = routed.filter(F.col("failure_reason").isNotNull()).select(*gate.QUARANTINE_COLUMNS)
            layout.write_quarantine(failed, quarantine_root, month, metrics.cast_failed + metrics.misfiled)
        kept = gate.with_partition_columns(routed.filter("keep").select(*BRONZE.names))
        layout.replace_month(kept.select(*EVENTS.names), root, month)
    return metrics


#: Kinds of rows beside those shown: without a key because it is absent, or because it did not
#: convert; of another month, and that with columns that did not convert.
KEYLESS, REJECTED, MISFILED_CLEAN, MISFILED_FAILED = "keyless", "rejected", "misfiled", "misfiled_failed"
_ASIDE = (KEYLESS, REJECTED, MISFILED_CLEAN, MISFILED_FAILED)


def _load_published(
    spark: SparkSession, bronze: DataFrame, root: str, month: str, quarantine_root: str | None, may_empty: bool
) -> LoadMetrics:
    """Rows are written once, by kind, under a version; rows set aside go again when it is published."""
    version = uuid.uuid4().hex
    counts = versions.write_routed(_by_kind(route(bronze, month), month), root, version)
    count = lambda *kinds: sum(counts.get(kind, 0) for kind in kinds)
    metrics = LoadMetrics(
        total=sum(counts.values()),
        cast_failed=count(FAILED, REJECTED, MISFILED_FAILED),
        processed=count(CLEAN, FAILED),
        dropped=count(KEYLESS, REJECTED),
        misfiled=count(MISFILED_CLEAN, MISFILED_FAILED),
    )
    logger.info("%s", metrics)
    try:
        _assert_safe(metrics, month, quarantine_root is not None, may_empty)
    except LoadRefused:
        versions.discard(spark, root, version)
        raise
    if quarantine_root:
        faulty = (FAILED, REJECTED, MISFILED_CLEAN, MISFILED_FAILED)
        strings = T.StructType([T.StructField(c, T.StringType()) for c in gate.QUARANTINE_COLUMNS])
        rows = versions.routed(spark, root, version, strings, faulty)
        layout.write_quarantine(rows, quarantine_root, month, count(*faulty))
    versions.publish(spark, root, version, REPLACE, [month])
    versions.discard(spark, root, version, _ASIDE)
    return metrics


def _by_kind(routed: DataFrame, month: str) -> DataFrame:
    """Processed columns, raw values of faulty rows, and the keys of the layout."""
    reason, kept = F.col("failure_reason"), F.col("keep")
    kind = (
        F.when(kept & reason.isNull(), CLEAN)
        .when(kept, FAILED)
        .when(F.col("astray") & (reason == MISFILED), MISFILED_CLEAN)
        .when(F.col("astray"), MISFILED_FAILED)
        .when(reason.isNull(), KEYLESS)
        .otherwise(REJECTED)
    )
    dated = gate.with_partition_columns(routed.withColumn("rows", kind))
    held = [c for c in gate.QUARANTINE_COLUMNS if c.endswith("_raw")]
    placed = {"event_month": F.lit(month), "event_date": F.when(kept, F.col("event_date"))}
    return dated.withColumns(placed).select(*EVENTS.names, *held, "failure_reason", "rows")


def _assert_safe(metrics: LoadMetrics, month: str, quarantined: bool, may_empty: bool) -> None:
    if metrics.misfiled and not quarantined:
        raise LoadRefused(f"{month}: {metrics.misfiled:,} rows of another month and no quarantine for them ({metrics})")
    if metrics.total and not metrics.processed and not may_empty:
        raise LoadRefused(f"{month}: none of {metrics.total:,} rows belongs to the month ({metrics})")


def _metrics(routed: DataFrame) -> LoadMetrics:
    counted = routed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("failure_reason").isNotNull() & (F.col("failure_reason") != MISFILED)).alias("cast_failed"),
        F.count_if("keep").alias("processed"),
        F.count_if("lacks_key").alias("dropped"),
        F.count_if("astray").alias("misfiled"),
    )
    return LoadMetrics(**counted.first().asDict())
