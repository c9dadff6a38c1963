"""The raw log as CSV files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.schemas import BRONZE

Paths = str | Sequence[str]

# Fixed month abbreviations in the names of the monthly files.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def first_day(month: str) -> date:
    """First day of a month given as ``2019-10``; anything else is an error."""
    if not re.fullmatch(r"\d{4}-\d\d", month):
        raise ValueError(f"month must look like 2019-10, got {month!r}")
    return date.fromisoformat(f"{month}-01")


def month_file(root: str, month: str) -> str:
    """Path of a month's file: ``2019-10`` is ``<root>/2019-Oct.csv``."""
    day = first_day(month)
    return f"{root.rstrip('/')}/{day.year}-{MONTH_NAMES[day.month - 1]}.csv"


def scan_bronze(spark: SparkSession, paths: Paths) -> DataFrame:
    """One or more CSV files with every column a string, so no value is lost in reading.

    Columns bind by position. A path that matches nothing is an error, not an empty
    result.
    """
    return spark.read.schema(BRONZE).csv(paths if isinstance(paths, str) else list(paths), header=True)


def first_rows(spark: SparkSession, paths: Paths, n: int = 100_000) -> DataFrame:
    """A sample: the first ``n`` rows, files in the order of their paths.

    Rows are counted by split, file by file until the sample is full, so later files are never
    opened. What is returned reads the files before the last whole, of the last the splits that
    lie before the sample's end, and of one split its first rows. Nothing is sorted, and only
    those last rows pass through one task. Splits of one file alone do not depend on other files.
    """
    files = [r.path for r in input_files(spark, paths).select("path").orderBy("path").collect()]
    parts, left = [], n
    for path in files:
        if left <= 0:
            break
        file = scan_bronze(spark, path)
        splits = _rows_by_split(file)
        count = sum(splits.values())
        parts += [file] if count <= left else _first_of(file, splits, left)
        left -= count
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], BRONZE)


def _rows_by_split(file: DataFrame) -> dict[int, int]:
    counted = file.groupBy(F.col("_metadata.file_block_start").alias("start")).count()
    return {r["start"]: r["count"] for r in counted.collect()}


def _first_of(file: DataFrame, splits: dict[int, int], n: int) -> list[DataFrame]:
    """The first ``n`` rows of a file that has more: whole splits, and the first rows of one."""
    start = F.col("_metadata.file_block_start")
    for at in sorted(splits):
        if splits[at] >= n:
            return [file.filter(start < at), file.filter(start == at).limit(n)]
        n -= splits[at]
    raise ValueError("the file has fewer rows")


def input_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per input file, in sub-folders too, with its size; contents are never opened.

    A path that matches nothing raises ``PATH_NOT_FOUND``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(paths if isinstance(paths, str) else list(paths))
    return files.select(
        "path",
        F.col("length").alias("bytes"),
        (F.col("length") / 1024**2).alias("megabytes"),
    )


def input_bytes(spark: SparkSession, paths: Paths) -> int:
    return input_files(spark, paths).agg(F.sum("bytes")).first()[0] or 0
