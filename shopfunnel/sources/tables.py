"""Partitioned Parquet as a path or as a catalog table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.schemas import COLUMN_DOCS, EVENTS
from shopfunnel.session import entries
from shopfunnel.sources import versions
from shopfunnel.sources.csv import input_bytes

PARTITION_KEYS = ("event_month", "event_date")


def read_events(spark: SparkSession, root: str, *parts: str) -> DataFrame:
    """The event dataset under ``root``, partition columns found from the folder names.

    ``parts`` may name folders below the root (``event_month=2019-10``); the partition
    columns are found all the same. The declared schema keeps a month a string and a
    day a date whatever the folder names look like. Of a dataset with published versions
    exactly those are read; parts can only name months there.
    """
    if versions.is_versioned(spark, root):
        return _read_published(spark, root, [p.removeprefix("event_month=") for p in parts])
    return _read_folders(spark, root, [f"{root.rstrip('/')}/{part}" for part in parts] or [root])


def _read_folders(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(EVENTS).option("basePath", root).parquet(*paths).select(*EVENTS.names)


def _read_published(spark: SparkSession, root: str, months: list[str]) -> DataFrame:
    """Folders named by a version and those that are not are read apart: their columns differ."""
    named = [
        (version, folder)
        for month in months or versions.all_months(spark, root)
        for version, folder in versions.month_folders(spark, root, month).items()
    ]
    kinds = [[f for v, f in named if v], [f for v, f in named if not v]]
    read = [_read_folders(spark, root, folders) for folders in kinds if folders]
    return reduce(DataFrame.unionAll, read) if read else spark.createDataFrame([], EVENTS)


def register_external(spark: SparkSession, table: str, root: str) -> DataFrame:
    """An external table over the files under ``root``; a table of that name is replaced.

    The declared columns come first and the partition keys last. The partitions are
    read from the folders, without which the table would be empty. Over a dataset with
    published versions the table has a partition key for the version too, and the
    partitions published now.
    """
    versioned = versions.is_versioned(spark, root)
    keys = [EVENTS[name] for name in PARTITION_KEYS]
    if versioned:
        keys.insert(0, T.StructField("version", T.StringType()))
    data = [f for f in EVENTS.fields if f.name not in PARTITION_KEYS]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in [*data, *keys])
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:name) ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(f.name for f in keys)}) LOCATION :root",
        args={"name": table, "root": root},
    )
    if versioned:
        refresh_external(spark, table, root)
    else:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def refresh_external(spark: SparkSession, table: str, root: str, months: Sequence[str] = ()) -> None:
    """Bring the partitions of a table registered over a dataset up to date, of some months or of all."""
    wanted: dict[tuple[str, ...], str] = {}
    for month in months or versions.all_months(spark, root):
        for version, folder in versions.month_folders(spark, root, month).items():
            for name in entries(spark, folder):
                if name.startswith("event_date="):
                    wanted[version or "none", month, name.removeprefix("event_date=")] = f"{folder}/{name}"
    keys = ("version", *PARTITION_KEYS) if "version" in spark.table(table).columns else PARTITION_KEYS
    places = {key[-len(keys) :]: place for key, place in wanted.items()}
    have = set()
    for row in spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": table}).collect():
        values = tuple(part.partition("=")[2] for part in row.partition.split("/"))
        if not months or values[-2] in months:
            have.add(values)
    spec = lambda values: "(" + ", ".join(f"{k} = '{v}'" for k, v in zip(keys, values)) + ")"
    gone, new = sorted(have - places.keys()), sorted(places.keys() - have)
    for some in (gone[k : k + 500] for k in range(0, len(gone), 500)):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION " + ", PARTITION ".join(map(spec, some)))
    for some in (new[k : k + 500] for k in range(0, len(new), 500)):
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"PARTITION {spec(v)} LOCATION '{places[v]}'" for v in some))
    spark.catalog.refreshTable(table)


def table_bytes(spark: SparkSession, table: str) -> int:
    """Size of a table's files."""
    about = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": table})
    return input_bytes(spark, about.filter("col_name = 'Location'").first()["data_type"])


def source(spark: SparkSession, table: str) -> DataFrame:
    """A registered table as the models' input, its columns carrying their descriptions."""
    df = spark.table(table)
    return df.select(
        *[
            F.col(name).alias(name, metadata={"comment": COLUMN_DOCS[name]}) if name in COLUMN_DOCS else name
            for name in df.columns
        ]
    )
