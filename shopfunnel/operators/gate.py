"""The row-quality gate between the raw log and the processed rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.functions import events as E
from shopfunnel.operators.reshape import rows_of
from shopfunnel.schemas import BRONZE, GATED, KEYS, PROCESSED, conform

#: Columns of a quarantined row: the raw values and why the row is there.
QUARANTINE_COLUMNS = [f"{c}_raw" if c in GATED else c for c in BRONZE.names] + ["failure_reason"]


def with_typed(bronze: DataFrame) -> DataFrame:
    """The raw log plus, for each gated column, the text it held and its typed value."""
    raw = {f"{c}_raw": F.col(c) for c in GATED}
    typed = {f"{c}_typed": E.typed_value(c) for c in GATED}
    return bronze.withColumns({**raw, **typed})


def with_row_id(df: DataFrame) -> DataFrame:
    """A surrogate id, unique within one evaluation of the plan but not stable across them."""
    return df.withColumn("_row_id", F.monotonically_increasing_id())


def with_failure_reason(typed: DataFrame) -> DataFrame:
    return typed.withColumn("failure_reason", E.failure_reason())


def quarantined(typed: DataFrame) -> DataFrame:
    """Rows in which some value is present but did not convert.

    A row whose keys converted is here *and* in :func:`processed`; a row that merely
    lacks a key is in neither.
    """
    failed = typed.filter(E.any_conversion_failed())
    return with_failure_reason(failed).select(*QUARANTINE_COLUMNS)


def processed(typed: DataFrame) -> DataFrame:
    """Rows whose keys converted, under the processed schema."""
    kept = typed.filter(E.has_keys())
    return conform(
        kept.select(*[F.col(f"{c}_typed").alias(c) if c in GATED else c for c in PROCESSED.names]),
        PROCESSED,
    )


def with_partition_columns(df: DataFrame) -> DataFrame:
    time = F.col("event_time")
    return df.withColumns(
        {
            "event_month_date": E.month_start(time),
            "event_date": E.event_date(time),
            "event_month": E.event_month(time),
        }
    )


def row_metrics(typed: DataFrame) -> DataFrame:
    """One row of counts and rates over the gate; every row is accounted for.

    ``total = processed + dropped_bad_key + dropped_null_key``. Rates are fractions,
    0.0 for an empty input.
    """
    failed, kept = E.any_conversion_failed(), E.has_keys()
    bad_key = reduce(or_, map(E.conversion_failed, KEYS))
    counts = typed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(failed).alias("cast_failed"),
        F.count_if(kept).alias("processed"),
        F.count_if(~kept & bad_key).alias("dropped_bad_key"),
        F.count_if(~kept & ~bad_key).alias("dropped_null_key"),
    )
    return with_gate_rates(counts)


def with_gate_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "cast_failed_rate": F.coalesce(F.try_divide("cast_failed", "total"), F.lit(0.0)),
            "processed_rate": F.coalesce(F.try_divide("processed", "total"), F.lit(0.0)),
        }
    )


def failures_by_column(typed: DataFrame) -> DataFrame:
    """How often each gated column failed to convert, from one aggregate."""
    counts = typed.agg(*[F.count_if(E.conversion_failed(c)).alias(c) for c in GATED])
    return rows_of(counts, [{"column_name": F.lit(c), "failures": F.col(c)} for c in GATED])
