"""Expressions over the columns of one event."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopfunnel.schemas import GATED, KEYS, PROCESSED, STAGES

# Fixed text format of event times in the raw log: UTC, with or without saying so.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_SUFFIX = " UTC"
TIME_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d( UTC)?\z"


def parse_event_time(raw: Column) -> Column:
    """UTC event time, NULL where the text is anything but the fixed format.

    The cast to timestamp accepts many more forms, so the pattern admits the one first;
    together they take two thirds of the time of ``try_to_timestamp`` with a format.
    """
    return F.when(raw.rlike(TIME_PATTERN), F.left(raw, F.lit(len(TIME_FORMAT))).try_cast("timestamp"))


def typed_value(name: str) -> Column:
    """The raw column in its processed type; a value that does not convert is NULL.

    ``try_cast`` keeps that true under ANSI mode, where a plain cast would stop the
    job on the first bad row.
    """
    if name == "event_time":
        return parse_event_time(F.col(name))
    return F.col(name).try_cast(PROCESSED[name].dataType)


def conversion_failed(name: str) -> Column:
    """A value is present but did not convert."""
    return F.col(f"{name}_raw").isNotNull() & F.col(f"{name}_typed").isNull()


def any_conversion_failed() -> Column:
    return reduce(or_, map(conversion_failed, GATED))


def failure_reason() -> Column:
    """Names of the columns that did not convert, in fixed order; NULL for a clean row."""
    names = F.concat_ws(", ", *[F.when(conversion_failed(c), F.lit(c)) for c in GATED])
    return F.nullif(names, F.lit(""))


def has_keys() -> Column:
    """The event can be placed: its time, user and product all converted."""
    return reduce(and_, [F.col(f"{name}_typed").isNotNull() for name in KEYS])


def event_date(time: Column) -> Column:
    return F.to_date(time)


def event_month(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def month_start(time: Column) -> Column:
    return F.trunc(time, "month")


def category_main(code: Column) -> Column:
    """Top level of a dotted category path; NULL stays NULL, empty stays empty."""
    return F.substring_index(code, ".", 1)


def is_funnel_event() -> Column:
    """The event has a funnel type and all three identifiers of a funnel row."""
    return F.col("event_type").isin(*STAGES) & reduce(
        and_, [F.col(c).isNotNull() for c in ("user_id", "user_session", "product_id")]
    )


def reached(stage: str) -> Column:
    """0/1 aggregate: some event of the group has this type."""
    return F.max(F.when(F.col("event_type") == stage, 1).otherwise(0)).alias(f"has_{stage}")


def furthest_stage() -> Column:
    """The last stage reached: purchase over cart over view."""
    return F.coalesce(*[F.when(F.col(f"has_{s}") == 1, F.lit(s)) for s in reversed(STAGES)])


def rate(part: Column | str, whole: Column | str) -> Column:
    """Percentage with two decimals; NULL over a zero whole."""
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.round(F.try_divide(part, whole) * 100, 2)
