"""Turning one wide row of aggregates into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of(wide: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """One output row per mapping, each a row of expressions over the one row of ``wide``.

    Lets any number of counts come out of a single aggregate over the data.
    """
    structs = [F.struct(*[e.alias(name) for name, e in row.items()]) for row in rows]
    return wide.select(F.inline(F.array(*structs)))
