"""Exact numeric statistics without bringing a column's values together in one task."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal, localcontext
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.session import work_table

#: Buckets an interval of distinct values is cut into.
BUCKETS = 256
#: Distinct values one task may sort; intervals with more of them are cut again.
MOST = 1_000_000
#: Digits behind the point that interpolation between two exact values adds.
ADDED_SCALE = 6

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_LONG_DIGITS = 19
#: A difference of two values needs a digit more than the values, and a decimal has 38.
_MOST_DIGITS = 37

Number = float | int | Decimal


@dataclass
class Stats:
    """Statistics of one column; exact columns have ``int`` or ``Decimal`` values, others ``float``."""

    column_name: str
    count: int = 0
    mean: float | None = None
    std: float | None = None
    min: Number | None = None
    max: Number | None = None
    #: Per probability a rank and the values there and at the next, between which the quantile lies.
    neighbours: list[tuple[int, Number, Number]] | None = None


@dataclass
class _Interval:
    """A range of a column's distinct values with the ranks sought in it."""

    column_name: str
    mean: float
    low_value: float
    high_value: float
    low_exact: Number | None
    high_exact: Number | None
    ranks: list[int]
    before: int = 0
    rows: int = 0

    @property
    def low(self) -> Number:
        return self.low_value if self.low_exact is None else self.low_exact


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, n)``: how often each number occurs in each column, as a double.

    Missing values and NaN are left out. Repeated values meet in the map-side aggregate,
    so even a value that fills a third of the rows shuffles as one row per task.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numbers.unpivot([], list(columns), "column_name", "value")
    present = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return present.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_columns(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], T.DataType]:
    """The columns whose values are kept digit by digit, and one type that holds them all.

    Whole numbers always are; decimals are if all of them fit into one decimal of 37 digits.
    """
    whole = [c for c in columns if isinstance(df.schema[c].dataType, _INTEGRAL)]
    kinds = {c: df.schema[c].dataType for c in columns if isinstance(df.schema[c].dataType, T.DecimalType)}
    if not kinds:
        return whole, T.LongType()
    scale = max(0, *(k.scale for k in kinds.values()))
    digits = max([k.precision - k.scale for k in kinds.values()] + ([_LONG_DIGITS] if whole else []))
    if digits + scale > _MOST_DIGITS:
        return whole, T.LongType()
    return [c for c in columns if c in kinds or c in whole], T.DecimalType(digits + scale, scale)


def numeric_stats(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    buckets: int = BUCKETS,
    most: int = MOST,
) -> DataFrame:
    """Count, mean, sample deviation, range and exact quantiles of each column, as doubles.

    :func:`exact_stats` gives range and quantiles of whole and decimal columns unrounded.
    """

    def at(s: Stats, probability: float, below: int, low: Number, high: Number) -> float:
        low, high = float(low), float(high)
        return low if low == high else low + (high - low) * (probability * (s.count - 1) - below)

    rows = [
        (
            s.column_name,
            s.count,
            s.mean,
            s.std,
            _double(s.min),
            s.neighbours and [at(s, p, *n) for p, n in zip(probabilities, s.neighbours, strict=True)],
            _double(s.max),
        )
        for s in column_statistics(df, columns, probabilities, buckets, most)
    ]
    schema = "column_name string, count bigint, mean double, std double, min double, quantiles array<double>, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def exact_stats(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    buckets: int = BUCKETS,
    most: int = MOST,
) -> DataFrame:
    """``count``, ``min``, ``quantiles`` and ``max`` of whole and decimal columns, as decimals.

    Ids of 19 digits come back as they are. Quantiles between two values have up to six digits
    more behind the point, as far as 38 digits allow, and are rounded half even there.
    """
    exact, kind = exact_columns(df, columns)
    if left := [c for c in columns if c not in exact]:
        raise ValueError(f"not whole numbers, nor decimals within {_MOST_DIGITS} digits: {', '.join(left)}")
    digits, scale = (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (_LONG_DIGITS, 0)
    scale = min(scale + ADDED_SCALE, 38 - (digits - scale))

    def held(number: Number | None) -> Decimal | None:
        return None if number is None else Decimal(number).quantize(Decimal(1).scaleb(-scale))

    def at(s: Stats, probability: float, below: int, low: Number, high: Number) -> Decimal:
        part = _position(probability, s.count) - below
        return held(Decimal(low) + Decimal(high - low) * part.numerator / part.denominator)

    number = f"decimal(38,{scale})"
    schema = f"column_name string, count bigint, min {number}, quantiles array<{number}>, max {number}"
    with localcontext(prec=100):
        rows = [
            (
                s.column_name,
                s.count,
                held(s.min),
                s.neighbours and [at(s, p, *n) for p, n in zip(probabilities, s.neighbours, strict=True)],
                held(s.max),
            )
            for s in column_statistics(df, columns, probabilities, buckets, most)
        ]
        return df.sparkSession.createDataFrame(rows, schema)


def column_statistics(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    buckets: int = BUCKETS,
    most: int = MOST,
) -> list[Stats]:
    """Statistics of each column, in the order given.

    Quantiles interpolate linearly between the two nearest ranks. ``percentile`` would hold
    all distinct values of a column in one task. Here the data are scanned and shuffled once,
    into distinct values with their counts. These are cut into buckets, the ranks sought are
    located by the buckets' totals, and a bucket that has a rank and more than ``most`` distinct
    values is cut again: each round divides it by about ``buckets``, so 256 million values take
    one round and 65 billion two. What is left is sorted, at most ``most`` values a task.

    A sketch places the cuts by a double, but the result is exact wherever they fall: values of
    whole and decimal columns are placed by their distance to the bucket's smallest, which a
    double tells apart ever better as buckets narrow, and compared digit by digit. The smallest
    value is always cut off, so a round makes progress on any data.

    The driver sees one row per column, sought rank and bucket. NaN counts as missing; columns
    without values have a count of 0 and nothing else.
    """
    if not columns:
        return []
    stats = {c: Stats(c) for c in columns}
    with work_table(_frequencies(df, columns), "value-frequencies") as frequencies:
        spans = []
        for row in _overview(frequencies).collect():
            of = stats[row.column_name]
            of.count, of.mean = row["count"], row.mean
            whole = row.low_exact is not None
            of.min, of.max = (row.low_exact, row.high_exact) if whole else (row.low_value, row.high_value)
            ranks = sorted({rank for p in probabilities for rank in _ranks(p, of.count)})
            spans.append(
                _Interval(of.column_name, of.mean, row.low_value, row.high_value, row.low_exact, row.high_exact, ranks)
            )
        found: dict[str, dict[int, Number]] = {c: {} for c in columns}
        first, leaves = True, []
        while spans:
            narrower = []
            for span, parts in _cut(frequencies, spans, buckets):
                if first and (count := stats[span.column_name].count) > 1:
                    stats[span.column_name].std = math.sqrt(sum(p.squares for p in parts) / (count - 1))
                narrower.extend(_holding(span, parts))
            first, spans = False, []
            for part in narrower:
                if part.rows == 1:
                    found[part.column_name].update(dict.fromkeys(part.ranks, part.low))
                else:
                    (leaves if part.rows <= most else spans).append(part)
        for column, rank, number in _sorted_out(frequencies, leaves):
            found[column][rank] = number
    for column, of in stats.items():
        if of.count:
            of.neighbours = [
                (below, found[column][below], found[column][above])
                for below, above in (_ranks(p, of.count) for p in probabilities)
            ]
    return list(stats.values())


def _frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, exact, value, n)``; ``exact`` is null in columns of floating numbers."""
    exact, kind = exact_columns(df, columns)
    pairs = df.select(
        *[
            F.struct(
                (F.col(c) if c in exact else F.lit(None)).cast(kind).alias("exact"),
                F.col(c).cast("double").alias("value"),
            ).alias(c)
            for c in columns
        ]
    )
    long = pairs.unpivot([], list(columns), "column_name", "pair").select("column_name", "pair.exact", "pair.value")
    present = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return present.groupBy("column_name", "exact", "value").agg(F.count(F.lit(1)).alias("n"))


def _overview(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        *_range(),
    )


def _range() -> list[Column]:
    ends = (("low", F.min), ("high", F.max))
    return [end(c).alias(f"{name}_{c}") for name, end in ends for c in ("value", "exact")]


def _inside(frequencies: DataFrame, spans: Sequence[_Interval]) -> DataFrame:
    """The distinct values in any of the intervals, with the interval's number in ``span``."""
    exact = frequencies.schema["exact"].dataType
    schema = T.StructType(
        [
            T.StructField("column_name", T.StringType()),
            T.StructField("span", T.IntegerType()),
            T.StructField("mean", T.DoubleType()),
            T.StructField("before", T.LongType()),
            T.StructField("ranks", T.ArrayType(T.LongType())),
            *[T.StructField(f"{end}_value", T.DoubleType()) for end in ("low", "high")],
            *[T.StructField(f"{end}_exact", exact) for end in ("low", "high")],
        ]
    )
    rows = [
        (s.column_name, i, s.mean, s.before, s.ranks, s.low_value, s.high_value, s.low_exact, s.high_exact)
        for i, s in enumerate(spans)
    ]
    bounds = frequencies.sparkSession.createDataFrame(rows, schema)
    within = F.when(F.col("exact").isNull(), F.col("value").between(F.col("low_value"), F.col("high_value"))).otherwise(
        F.col("exact").between(F.col("low_exact"), F.col("high_exact"))
    )
    return frequencies.join(F.broadcast(bounds), "column_name").filter(within)


def _cut(frequencies: DataFrame, spans: Sequence[_Interval], buckets: int) -> Iterator[tuple[_Interval, list[Row]]]:
    """Each interval with its buckets in ascending order."""
    wide = frequencies.schema["exact"].dataType
    wide = wide if isinstance(wide, T.DecimalType) else T.DecimalType(_LONG_DIGITS, 0)
    distance = (F.col("exact").cast(wide) - F.col("low_exact").cast(wide)).cast("double")
    inside = _inside(frequencies, spans).withColumn("place", F.coalesce(distance, "value"))
    cut_at = F.expr(f"array({', '.join(f'{i / buckets}D' for i in range(1, buckets))})")
    cuts = inside.groupBy("span").agg(
        F.array_sort(
            F.array_union(F.array(F.min("place")), F.percentile_approx("place", cut_at, 10 * buckets))
        ).alias("cuts")
    )
    off_mean = F.col("value") - F.col("mean")
    totals = (
        inside.join(F.broadcast(cuts), "span")
        .withColumn("bucket", cuts_below(F.col("cuts"), F.col("place"), buckets))
        .groupBy("span", "bucket")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("n") * off_mean * off_mean).alias("squares"),
            *_range(),
        )
    )
    parts: list[list[Row]] = [[] for _ in spans]
    for row in sorted(totals.collect(), key=lambda row: row.bucket):
        parts[row.span].append(row)
    return zip(spans, parts, strict=True)


def _holding(span: _Interval, parts: Sequence[Row]) -> Iterator[_Interval]:
    """The buckets of an interval that hold ranks sought."""
    before = span.before
    for part in parts:
        upto = before + part.n
        if ranks := [r for r in span.ranks if before <= r < upto]:
            yield replace(
                span,
                low_value=part.low_value,
                high_value=part.high_value,
                low_exact=part.low_exact,
                high_exact=part.high_exact,
                ranks=ranks,
                before=before,
                rows=part.rows,
            )
        before = upto


def _sorted_out(frequencies: DataFrame, leaves: Sequence[_Interval]) -> Iterator[tuple[str, int, Number]]:
    """``(column_name, rank, value)`` of the ranks sought in intervals that one task sorts each."""
    if not leaves:
        return
    ascending = Window.partitionBy("span").orderBy("exact", "value")
    upto_here = F.sum("n").over(ascending.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = (
        _inside(frequencies, leaves)
        .withColumn("next", F.col("before") + upto_here)
        .withColumn("hits", F.filter("ranks", lambda r: (r >= F.col("next") - F.col("n")) & (r < F.col("next"))))
        .filter(F.size("hits") > 0)
    )
    for row in hits.select("column_name", "exact", "value", "hits").collect():
        for rank in row.hits:
            yield row.column_name, rank, row.value if row.exact is None else row.exact


def cuts_below(cuts: Column, value: Column, most: int) -> Column:
    """How many of the sorted ``cuts``, of which there are at most ``most``, are below ``value``.

    By halving: a step is taken where the cut it would pass is still below.
    """
    steps = F.lit([1 << bit for bit in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda passed, step: F.when(F.get(cuts, passed + step - 1) < value, passed + step).otherwise(passed),
    )


def _position(probability: float, count: int) -> Fraction:
    return Fraction(str(probability)) * (count - 1)


def _ranks(probability: float, count: int) -> tuple[int, int]:
    """The ranks at or next to a quantile."""
    at = _position(probability, count)
    return math.floor(at), math.ceil(at)


def _double(number: Number | None) -> float | None:
    return None if number is None else float(number)
