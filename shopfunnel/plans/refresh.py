"""The warehouse kept up to date by month: what a loaded month changes is built again, and no more.

The copies of the events, the fact and the marts are partitioned by month first. Staging works row by
row, and month and day are part of every key behind it, so a month of each table follows from the
same month of the table before. A refresh overwrites those partitions one table after the other, in
the order of their dependency, each in one static ``INSERT OVERWRITE``: days the month no longer has
go, and other months are neither read nor written. Check results are kept by month too, and sketches
of each day's values, from which :mod:`shopfunnel.operators.sketches` counts distinct ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.operators import checks, layout, sketches
from shopfunnel.operators.files import by_day
from shopfunnel.plans import models
from shopfunnel.plans.warehouse import (
    CLUSTERED,
    DAILY_TABLE,
    EXTERNAL,
    FACT_TABLE,
    MONTHLY_TABLE,
    PARTITIONED,
    check_models,
)
from shopfunnel.schemas import DAILY, EVENTS, FACT, MONTHLY, PROCESSED, assert_contract
from shopfunnel.session import sized_shuffle
from shopfunnel.sources import versions
from shopfunnel.sources.csv import input_bytes
from shopfunnel.sources.tables import refresh_external, register_external, source

CHECKS_TABLE = "check_failures"
DISTINCT_TABLE = "distinct_by_day"
MONTH = "event_month"
_CHECKS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField(MONTH, T.StringType()),
    ]
)
_DISTINCT = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField(MONTH, T.StringType()),
    ]
)
#: Contract of each table, and its partition keys.
TABLES = {
    PARTITIONED: (EVENTS, (MONTH, "event_date")),
    CLUSTERED: (EVENTS, (MONTH, "event_date")),
    FACT_TABLE: (FACT, (MONTH,)),
    MONTHLY_TABLE: (MONTHLY, (MONTH,)),
    DAILY_TABLE: (DAILY, (MONTH,)),
    CHECKS_TABLE: (_CHECKS, (MONTH,)),
    DISTINCT_TABLE: (_DISTINCT, (MONTH,)),
}


def refresh(
    spark: SparkSession,
    root: str,
    database: str = "default",
    months: Sequence[str] = (),
    cluster_by: Sequence[str] = ("event_type",),
    location: str | None = None,
    interleave: bool = False,
) -> list[tuple[str, str, str, int]]:
    """Build the given months of every table anew from the dataset under ``root``, or all of them.

    Tables that are not there yet are created. Raises like
    :func:`~shopfunnel.plans.warehouse.build_models` if a contract breaks, before the table is
    written, or if the checks of any month have found failing rows.
    """
    external = f"{database}.{EXTERNAL}"
    if not spark.catalog.tableExists(external):
        register_external(spark, external, root)
    else:
        refresh_external(spark, external, root, months)
    for table, (contract, keys) in TABLES.items():
        _create(spark, f"{database}.{table}", contract, keys, f"{location.rstrip('/')}/{table}" if location else None)
    for month in months or versions.all_months(spark, root):
        folders = versions.month_folders(spark, root, month).values()
        with sized_shuffle(spark, sum(input_bytes(spark, folder) for folder in folders)):
            refresh_month(spark, database, month, cluster_by, interleave)
    return checks.enforce([merged_checks(spark, database)])


def refresh_month(
    spark: SparkSession,
    database: str,
    month: str,
    cluster_by: Sequence[str] = ("event_type",),
    interleave: bool = False,
) -> None:
    """One month of every table behind the external one."""
    events = of_month(spark, database, EXTERNAL, month).select(*EVENTS.names)
    _overwrite(by_day(events), database, PARTITIONED, month)
    _overwrite(layout.clustered(events, cluster_by, interleave), database, CLUSTERED, month)
    _overwrite(
        sketches.day_sketches(of_month(spark, database, CLUSTERED, month), PROCESSED.names).hint("rebalance"),
        database,
        DISTINCT_TABLE,
        month,
    )
    staged = models.staging(of_month(spark, database, CLUSTERED, month))
    _overwrite(models.funnel_fact(staged), database, FACT_TABLE, month)
    fact = of_month(spark, database, FACT_TABLE, month)
    _overwrite(models.monthly_mart(fact), database, MONTHLY_TABLE, month)
    _overwrite(models.daily_mart(fact), database, DAILY_TABLE, month)
    monthly, daily = (of_month(spark, database, table, month) for table in (MONTHLY_TABLE, DAILY_TABLE))
    first, *rest = check_models(staged, fact, monthly, daily)
    for more in rest:
        first = first.unionByName(more)
    _overwrite(first.withColumn(MONTH, F.lit(month)), database, CHECKS_TABLE, month)


def of_month(spark: SparkSession, database: str, table: str, month: str) -> DataFrame:
    """A month of a table, columns in the order of its contract."""
    contract = TABLES[table][0] if table in TABLES else EVENTS
    return source(spark, f"{database}.{table}").filter(F.col(MONTH) == month).select(*contract.names)


def merged_checks(spark: SparkSession, database: str = "default") -> DataFrame:
    """The results of all months as those of one run: failing rows add up, columns off a contract do not."""
    kept = spark.table(f"{database}.{CHECKS_TABLE}")
    failures = F.when(F.col("check_name") == "contract", F.max("failures")).otherwise(F.sum("failures"))
    return kept.groupBy("model", "column_name", "check_name").agg(failures.alias("failures"))


def _create(spark: SparkSession, table: str, contract: T.StructType, keys: Sequence[str], path: str | None) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in contract.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)})" + (" LOCATION :path" if path else ""),
        args={"name": table} | ({"path": path} if path else {}),
    )


def _overwrite(rows: DataFrame, database: str, table: str, month: str) -> None:
    contract, keys = TABLES[table]
    rows = assert_contract(rows, contract, table)
    columns = [c for c in contract.names if c not in keys] + list(keys[1:])
    spark, key = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        spark.sql(
            f"INSERT OVERWRITE IDENTIFIER(:name) PARTITION ({', '.join([f'{MONTH} = :month', *keys[1:]])}) "
            "SELECT * FROM {rows}",
            args={"name": f"{database}.{table}", "month": month},
            rows=rows.select(*columns),
        )
    finally:
        spark.conf.set(key, before)
