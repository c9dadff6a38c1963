"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.session import remove, work_path, written


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables :func:`saved` inside the ``with`` block are deleted at its end."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: lineage ends there."""
    path = work_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    return written(df, path)


def result(df: DataFrame, name: str) -> DataFrame:
    """:func:`saved` for what outlives a :func:`scratch` block."""
    return written(df, work_path(df.sparkSession, name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What tasks leave in their worker for the next ones, by whose it is: how to forget it.
_kept: dict[str, Callable[[], object]] = {}


def keeps(owner: str, forget: Callable[[], object]) -> None:
    """``owner``'s tasks leave something in their worker; ``forget`` drops it."""
    _kept[owner] = forget


def only(owner: str = "") -> None:
    """Called by a task: drops what others' tasks have left in this worker, which goes on from stage to stage."""
    for name, forget in _kept.items():
        if name != owner:
            forget()
    give_back()


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where its C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def same(left: Column, right: Column) -> Column:
    """Equality that also holds between nulls."""
    return left.eqNullSafe(right)
