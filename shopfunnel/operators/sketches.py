"""Distinct counts of any range of days from small sketches kept by day."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Binary logarithm of a sketch's registers; 2^14 of them take 16 kB at most.
LG_K = 14
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def error_bound(lg_k: int = LG_K) -> float:
    """Three standard errors of a merged sketch, as a share of the count: 2.4 % by default."""
    return 3 * 1.04 / math.sqrt(2**lg_k)


def day_sketches(events: DataFrame, columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``(event_month, event_date, column_name, sketch)``: the values each column has on each day.

    One aggregate over one scan. A task sends a sketch per day and column, however many rows or
    distinct values it saw, so a day with a third of all rows costs no more than any other.
    Missing values do not count; empty texts and NaN are values like others, -0.0 is 0.0.
    """
    days = events.groupBy("event_month", "event_date").agg(
        *[F.hll_sketch_agg(_key(events, c), lg_k).alias(c) for c in columns]
    )
    return days.unpivot(["event_month", "event_date"], list(columns), "column_name", "sketch")


def distinct_between(sketches: DataFrame, first: date, last: date) -> DataFrame:
    """``(column_name, distinct_values)`` of the days from ``first`` to ``last``, within :func:`error_bound`.

    Only sketches are read, and of those only the months' partitions.
    """
    return distinct_in_ranges(sketches, [(first, last)]).drop("first_day", "last_day")


def distinct_in_ranges(sketches: DataFrame, ranges: Sequence[tuple[date, date]]) -> DataFrame:
    """:func:`distinct_between` of several ranges, which may overlap, from one pass.

    A range without any day gives no row.
    """
    if not ranges:
        raise ValueError("no ranges given")
    months = (min(r[0] for r in ranges).strftime("%Y-%m"), max(r[1] for r in ranges).strftime("%Y-%m"))
    return (
        in_ranges(sketches.filter(F.col("event_month").between(*months)), ranges)
        .groupBy("first_day", "last_day", "column_name")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
    )


def in_ranges(rows: DataFrame, ranges: Sequence[tuple[date, date]]) -> DataFrame:
    """Each row once per range its ``event_date`` lies in, with ``first_day`` and ``last_day``."""
    known = F.array(*[F.struct(F.lit(a).alias("first_day"), F.lit(b).alias("last_day")) for a, b in ranges])
    day = F.col("event_date")
    fitting = F.filter(known, lambda r: (day >= r["first_day"]) & (day <= r["last_day"]))
    return rows.select("*", F.inline(fitting))


def _key(df: DataFrame, column: str) -> Column:
    """A value as a sketch takes it: whole numbers as such, all else as text that is never empty."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, _INTEGRAL):
        return value.cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)
    return F.concat(F.lit("="), value.cast("string"))  # sketches pass over empty text
