"""Publishing versions of months; :mod:`shopfunnel.sources.versions` tells what readers see."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.operators.files import write_by_day
from shopfunnel.session import create_empty, entries, exists, make_folder, remove
from shopfunnel.sources.versions import (
    APPEND,
    REPLACE,
    Marker,
    all_months,
    markers,
    months_in,
    published_folder,
    rows_folder,
    version_folder,
    visible,
)


def write_version(events: DataFrame, root: str, version: str) -> None:
    """Write rows where no reader looks before :func:`publish`.

    The dataset counts as versioned from here on, so that readers tell the rows from others.
    """
    make_folder(events.sparkSession, published_folder(root))
    write_by_day(events, rows_folder(root, version), "overwrite", "event_month", "event_date")


def write_routed(rows: DataFrame, root: str, version: str) -> dict[str, int]:
    """Write rows of several kinds, told by ``rows``, in one go; returns how many each kind has.

    The counts come from the footers of the files the commit has left, so they are right however
    often a task was repeated, and no row is read again.
    """
    spark, folder = rows.sparkSession, version_folder(root, version)
    make_folder(spark, published_folder(root))
    write_by_day(rows, folder, "overwrite", "rows", "event_month", "event_date")
    kinds = spark.read.schema("rows string, event_month string, event_date date").parquet(folder).groupBy("rows")
    return {r["rows"]: r["count"] for r in kinds.count().collect()}


def routed(spark: SparkSession, root: str, version: str, schema: T.StructType, kinds: Sequence[str]) -> DataFrame:
    """Rows of some kinds that :func:`write_routed` has written."""
    folder = version_folder(root, version)
    found = [path for kind in kinds if exists(spark, path := rows_folder(root, version, kind))]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*found).select(*schema.names)


def discard(spark: SparkSession, root: str, version: str, kinds: Sequence[str] = ()) -> None:
    """Delete some kinds of a version's rows, or all of them; not for what is published."""
    for folder in [rows_folder(root, version, kind) for kind in kinds] or [version_folder(root, version)]:
        remove(spark, folder)


def publish(spark: SparkSession, root: str, version: str, kind: str, months: Iterable[str]) -> None:
    """Make a written version count, month by month; again changes nothing.

    A month becomes visible whole, by one empty file.
    """
    for month in months:
        before = markers(spark, root, month)
        if any(m.version == version for m in before):
            continue
        number = before[-1].number + 1 if before else 1
        create_empty(spark, f"{published_folder(root, month)}/{Marker(number, kind, version).name}")


def replace_month(events: DataFrame, root: str, month: str) -> str:
    """Make ``month`` hold exactly the given rows of that month; returns the version's name.

    Until the last step readers see the month as it was. Rows of other months are not written.
    """
    version = uuid.uuid4().hex
    write_version(events.filter(F.col("event_month") == month), root, version)
    publish(events.sparkSession, root, version, REPLACE, [month])
    return version


def append_batch(events: DataFrame, root: str, batch: str) -> None:
    """Add the rows of a named batch, each to the month and day of its own time; again adds nothing.

    A batch that was written whole is not written again, so files readers may have open stay. A
    batch touches its own folder and the markers of its own months, however large the dataset is.
    """
    spark, folder = events.sparkSession, rows_folder(root, batch)
    if not exists(spark, f"{folder}/_SUCCESS"):
        write_version(events, root, batch)
    publish(spark, root, batch, APPEND, months_in(spark, folder))


def remove_superseded(spark: SparkSession, root: str, older_than: float = 86_400) -> list[str]:
    """Delete versions no month shows any more, or that were never published; returns their names.

    ``older_than`` seconds protect loads that are not published yet and readers of the last
    version: it has to exceed the longest of both.
    """
    shown = {m.version for month in all_months(spark, root) for m in visible(spark, root, month)}
    limit = (time.time() - older_than) * 1000
    old = [
        name.removeprefix("version=")
        for name, changed in entries(spark, root).items()
        if name.startswith("version=") and changed < limit
    ]
    gone = sorted(set(old) - shown)
    for month in all_months(spark, root):
        seen = visible(spark, root, month)
        for marker in markers(spark, root, month):
            if marker not in seen and marker.version in gone:
                remove(spark, f"{published_folder(root, month)}/{marker.name}")
    for version in gone:
        remove(spark, version_folder(root, version))
    return gone
