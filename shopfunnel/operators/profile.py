"""Dataset profile: shape, missing and distinct values, summaries, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.functions.events import rate
from shopfunnel.operators.quantiles import exact_columns, exact_stats, numeric_stats, value_frequencies
from shopfunnel.operators.reshape import rows_of
from shopfunnel.schemas import STAGES

QUARTILES = (0.25, 0.5, 0.75)


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def sample(df: DataFrame, n: int = 100_000) -> DataFrame:
    """Some ``n`` rows, for a quick look; :func:`~shopfunnel.sources.csv.first_rows` gives a file's first."""
    return df.limit(n)


def info(df: DataFrame) -> DataFrame:
    """Position, name, type and number of values of every column, from one aggregate."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return rows_of(
        counts,
        [
            {
                "position": F.lit(i),
                "column_name": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()),
                "non_null": F.col(f.name),
            }
            for i, f in enumerate(df.schema.fields)
        ],
    )


def head(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``keys``; files hold no order of their own in Spark."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def tail(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows by ``keys``."""
    return df.orderBy(*[F.col(k).desc_nulls_last() for k in keys]).limit(n)


def missing(df: DataFrame) -> DataFrame:
    """Missing values per column, most first, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [{"column_name": F.lit(c), "missing": F.col(c)} for c in df.columns]
    return rows_of(counts, rows).orderBy(F.desc("missing"), "column_name")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum per numeric column.

    NaN counts as missing.
    """
    stats = numeric_stats(df, list(columns or columns_of(df, T.NumericType)), QUARTILES)
    return stats.select("column_name", "count", "mean", "std", "min", *_quartiles(), "max")


def exact_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, minimum, quartiles and maximum of whole and decimal columns, digit by digit.

    :func:`numeric_summary` goes through double, which rounds ids above 2^53.
    """
    numeric = columns_of(df, T.NumericType)
    stats = exact_stats(df, list(columns or exact_columns(df, numeric)[0]), QUARTILES)
    return stats.select("column_name", "count", "min", *_quartiles(), "max")


def _quartiles() -> list[Column]:
    return [F.col("quantiles")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(QUARTILES)]


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(column_name, value, n)``, values as text, missing ones included; by ``keys``, if any.

    Each row is split into one short row per column, and equal values are merged before
    the shuffle, so one frequent value never lands on one task row by row.
    """
    text = df.select(*keys, *[_text(df, c) for c in columns])
    long = text.unpivot(list(keys), list(columns), "column_name", "value")
    return long.groupBy(*keys, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values, distinct values, the most frequent one and its count, per column.

    The smaller value wins a tie. A column without values has no most frequent one.
    Counts are aggregated before values are looked at: a minimum over text has to sort,
    and this way it sorts the values that tie for the first place and no others.
    """
    counts = value_counts(df, columns)
    present = F.col("value").isNotNull()
    stats = counts.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("count"),
        F.count_if(present).alias("unique"),
        F.max(F.when(present, F.col("n"))).alias("freq"),
    )
    # One row per column is broadcast, twice. A missing value as frequent as the first
    # place passes the join, but not the minimum.
    best = stats.select("column_name", F.col("freq").alias("n"))
    top = counts.join(F.broadcast(best), ["column_name", "n"]).groupBy("column_name").agg(F.min("value").alias("top"))
    return stats.join(F.broadcast(top), "column_name", "left").select("column_name", "count", "unique", "top", "freq")


def text_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, top value and its frequency per string column."""
    return column_stats(df, list(columns or columns_of(df, T.StringType)))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column, fewest first; missing values do not count.

    ``approximate`` trades about five percent of accuracy for a pass without a shuffle
    of values.
    """
    columns = list(columns or df.columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(c).alias(c) for c in columns])
    rows = [{"column_name": F.lit(c), "distinct_values": F.col(c)} for c in columns]
    return rows_of(wide, rows).orderBy("distinct_values", "column_name")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in every column, missing values being equal."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def event_mix(events: DataFrame) -> DataFrame:
    """Events per type and their share of all events, in percent."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    total = counts.agg(F.sum("events").alias("total")).scalar()
    return counts.withColumn("share", rate(F.col("events"), total))


def event_ratios(events: DataFrame) -> DataFrame:
    """One row: events of each funnel type, carts per view and purchases per cart in percent.

    These are ratios of event counts, not conversion rates: nothing ties a cart to a view.
    """
    counts = events.agg(*[F.count_if(F.col("event_type") == s).alias(f"{s}_events") for s in STAGES])
    return counts.withColumns(
        {f"{b}_per_{a}": rate(f"{b}_events", f"{a}_events") for a, b in zip(STAGES, STAGES[1:], strict=False)}
    )


def cardinalities(events: DataFrame) -> DataFrame:
    """One row: distinct categories, brands, products, users and sessions, the largest
    brand, and the most events in one session."""
    names = {
        "category_code": "categories",
        "brand": "brands",
        "product_id": "products",
        "user_id": "users",
        "user_session": "sessions",
    }
    stats = column_stats(events, list(names))

    def of(column: str, stat: str):
        return F.max(F.when(F.col("column_name") == column, F.col(stat)))

    return stats.agg(
        *[of(column, "unique").alias(name) for column, name in names.items()],
        of("brand", "top").alias("top_brand"),
        of("brand", "freq").alias("top_brand_events"),
        of("user_session", "freq").alias("most_events_in_session"),
    )


def price_profile(events: DataFrame) -> DataFrame:
    """Mean, median, range of the price, and how many events carry a price of zero."""
    at_zero = F.coalesce(F.sum(F.when(F.col("value") == 0, F.col("n"))), F.lit(0))
    zero = value_frequencies(events, ["price"]).agg(at_zero).scalar()
    return numeric_summary(events, ["price"]).select(
        "mean", F.col("p50").alias("median"), "min", "max", zero.alias("zero_prices")
    )


def _text(df: DataFrame, column: str):
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # -0.0 and 0.0 are one value
    return value.cast("string").alias(column)
