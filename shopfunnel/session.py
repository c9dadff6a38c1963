"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Applied by :func:`build_session`; a cluster may override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

def build_session(app_name: str = "shopfunnel", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Every date column derives from UTC event times; pin the session to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def sized_shuffle(spark: SparkSession, input_bytes: int, bytes_per_partition: int = 128 * 1024**2) -> Iterator[int]:
    """Shuffle partitions by the size of the input, for the length of a ``with`` block.

    AQE only merges partitions, so the default width would leave a 100 TB build with
    partitions of hundreds of gigabytes. The width never drops below what the session has,
    and AQE merges what is too fine.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    width = max(int(before), math.ceil(input_bytes / bytes_per_partition))
    spark.conf.set(key, str(width))
    try:
        yield width
    finally:
        spark.conf.set(key, before)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, the folder lies in the warehouse, which a cluster shares too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{root.rstrip('/')}/shopfunnel/{name}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str):
    """A path and the file system it is stored on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored."""
    fs, folder = _stored(spark, path)
    fs.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _stored(spark, path)
    return fs.exists(place)


def entries(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder with the times they were changed, in ms; none where there is no folder."""
    fs, place = _stored(spark, folder)
    if not fs.exists(place):
        return {}
    return {e.getPath().getName(): e.getModificationTime() for e in fs.listStatus(place)}


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _stored(spark, path)
    fs.mkdirs(folder)


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file; one that exists already stays."""
    fs, place = _stored(spark, path)
    fs.createNewFile(place)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once to ``path`` and read back.

    Cuts the lineage: later passes scan columnar files instead of evaluating ``df``
    again, and a lost executor costs no recomputation.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def work_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` :func:`written` to the work folder for the length of a ``with`` block."""
    spark = df.sparkSession
    path = work_path(spark, name)
    try:
        yield written(df, path)
    finally:
        remove(spark, path)
