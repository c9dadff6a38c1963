"""Data-quality checks: counted in one aggregate per table, enforced at the end."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.operators.reshape import rows_of
from shopfunnel.schemas import STAGES, contract_breaches


class CheckFailure(AssertionError):
    """Some check found failing rows."""


@dataclass(frozen=True)
class NotNull:
    column: str
    kind: str = "not_null"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """Any of ``values``; a missing value passes."""

    column: str
    values: tuple[str, ...]
    kind: str = "accepted_values"

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


Check = NotNull | AcceptedValues

STAGING_CHECKS = (
    AcceptedValues("event_type", STAGES),
    NotNull("user_id"),
    NotNull("user_session"),
    NotNull("product_id"),
)
FACT_CHECKS = (NotNull("event_date"), AcceptedValues("funnel_stage", STAGES))
DAILY_CHECKS = (NotNull("event_date"), NotNull("view_sessions"), NotNull("cart_sessions"))


def check(
    df: DataFrame, model: str, checks: Sequence[Check] = (), contract: T.StructType | None = None
) -> DataFrame:
    """One row per check, ``(model, column_name, check_name, failures)``.

    A contract adds a row that counts the columns off the declared names and types.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(c.fails()).alias(f"failures{i}") for i, c in enumerate(checks)],
    )
    found = [(c.column, c.kind, F.col(f"failures{i}")) for i, c in enumerate(checks)]
    if contract is not None:
        breaches = len(contract_breaches(df.schema, contract))
        found.append(("*", "contract", F.lit(breaches).cast("bigint")))
    return rows_of(
        counted,
        [
            {"model": F.lit(model), "column_name": F.lit(column), "check_name": F.lit(kind), "failures": n}
            for column, kind, n in found
        ],
    )


def enforce(results: Iterable[DataFrame]) -> list[tuple[str, str, str, int]]:
    """Run the checks; all results if they pass, :class:`CheckFailure` naming the failed ones.

    There is one row per check, whatever the size of the tables.
    """
    rows = [tuple(r) for r in reduce(DataFrame.unionByName, results).collect()]
    failed = [f"{m}.{c} {k}: {n}" for m, c, k, n in rows if n]
    if failed:
        raise CheckFailure("failing rows: " + "; ".join(failed))
    return rows
