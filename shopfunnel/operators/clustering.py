"""A sort order that serves filters on any of several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfunnel.operators.quantiles import cuts_below
from shopfunnel.session import work_table

#: Bits of a column's rank in the key: 256 classes of neighbouring values.
BITS = 8


def interleaved_order(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A key that interleaves the bits of the columns' ranks.

    Sorting by ``a, b, c`` scatters the values of ``b`` and ``c`` over all files. Sorted by this
    key, neighbouring rows are near each other in every column, so files, row groups and pages can
    be skipped by a filter on any of them. A column's distinct values are cut into ``2^bits``
    classes in their own order, all of about as many values; missing values come first.

    Takes one job per column, which ranks the distinct values without bringing them into one
    task. The key holds at most ``2^bits`` cuts per column, and needs ``bits`` times columns to
    be 63 at most.
    """
    if not columns or bits * len(columns) > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not make a key of 1 to 63 bits")
    ranks = [_rank(F.col(c), _cuts(rows, c, bits)) for c in columns]
    places = [(bit, j) for bit in range(bits) for j in range(len(columns))]
    parts = [
        F.shiftleft(F.shiftright(ranks[j], bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + len(columns) - 1 - j)
        for bit, j in places
    ]
    return reduce(Column.bitwiseOR, parts)


def interleaved(rows: DataFrame, columns: Sequence[str], leading: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """The rows dealt over tasks and sorted in them by ``leading``, then by :func:`interleaved_order`.

    Each task gets a range of the order, so each file covers few values of every column. Rows equal
    in all columns are told apart by a hash of the whole row, so that even a combination that
    fills a third of a day is split over tasks.
    """
    keyed = rows.withColumn("_order", interleaved_order(rows, columns, bits)).withColumn(
        "_spread", F.xxhash64(*rows.columns)
    )
    order = [*leading, "_order", "_spread"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*leading, "_order", *columns).select(*rows.columns)


def _cuts(rows: DataFrame, column: str, bits: int) -> list[tuple[object, int]]:
    """``(largest value, class)`` of the classes, ascending: at most ``2^bits``."""
    values = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    ordered = values.repartitionByRange(column).withColumn("_part", F.spark_partition_id())
    with work_table(ordered, "ranks") as ranked:
        sizes = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(
            "_part",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
            F.sum("_size").over(Window.partitionBy(F.lit(1))).alias("_all"),
        )
        at = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1 + F.col("_before")
        placed = ranked.join(offsets, "_part").withColumn("_class", F.floor(at * F.lit(2**bits) / F.col("_all")))
        classes = placed.groupBy("_class").agg(F.max(column).alias("_last")).collect()
    return sorted(((row["_last"], row["_class"]) for row in classes), key=lambda cut: cut[1])


def _rank(value: Column, cuts: Sequence[tuple[object, int]]) -> Column:
    if not cuts:
        return F.lit(0)
    last, classes = (F.array(*map(F.lit, side)) for side in zip(*cuts, strict=True))
    # Values written since the cuts were taken may lie behind the last.
    nearest = F.least(cuts_below(last, value, len(cuts)), F.lit(len(cuts) - 1))
    return F.when(value.isNull(), 0).otherwise(F.get(classes, nearest)).cast("int")
