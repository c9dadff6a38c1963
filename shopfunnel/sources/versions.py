"""Which versions of a dataset's months readers see.

    <root>/version=<name>/rows=<kind>/event_month=<month>/event_date=<day>/part-...   written once
    <root>/_published/event_month=<month>/<number>.<replace or append>.<name>          empty marker files

Rows count once a marker of their month names their version. A ``replace`` marker hides all that
its month held before, an ``append`` marker adds to it; markers count in the order of their names.
Creating one empty file is the whole commit, atomic on any store, so an aborted load leaves the
month as it was, and of two loads at once the one with the later name stands, whole. Folders of
months beside the versions are what those months held before the first marker. Of the kinds of
rows a load tells apart, readers see those that belong to the month, :data:`SHOWN`.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession

from shopfunnel.session import entries, exists

PUBLISHED = "_published"
REPLACE, APPEND = "replace", "append"
#: Rows without a fault, and with one that does not keep them from being used.
SHOWN = CLEAN, FAILED = "clean", "failed"
_MONTH = "event_month="


class Marker(NamedTuple):
    number: int
    kind: str
    version: str

    @property
    def name(self) -> str:
        return f"{self.number:012d}.{self.kind}.{self.version}"

    @classmethod
    def parse(cls, name: str) -> Marker:
        number, kind, version = name.split(".", 2)
        return cls(int(number), kind, version)


def published_folder(root: str, month: str = "") -> str:
    folder = f"{root.rstrip('/')}/{PUBLISHED}"
    return f"{folder}/{_MONTH}{month}" if month else folder


def version_folder(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def rows_folder(root: str, version: str, kind: str = CLEAN, month: str = "") -> str:
    folder = f"{version_folder(root, version)}/rows={kind}"
    return f"{folder}/{_MONTH}{month}" if month else folder


def is_versioned(spark: SparkSession, root: str) -> bool:
    return exists(spark, published_folder(root))


def months_in(spark: SparkSession, folder: str) -> list[str]:
    return sorted(name.removeprefix(_MONTH) for name in entries(spark, folder) if name.startswith(_MONTH))


def markers(spark: SparkSession, root: str, month: str) -> list[Marker]:
    """Of a month, in the order they count."""
    names = entries(spark, published_folder(root, month))
    return sorted((Marker.parse(n) for n in names if not n.startswith(".")), key=lambda m: m.name)


def visible(spark: SparkSession, root: str, month: str) -> list[Marker]:
    """Markers whose rows the month holds."""
    found = markers(spark, root, month)
    replaced = [k for k, m in enumerate(found) if m.kind == REPLACE]
    return found[replaced[-1] :] if replaced else found


def month_folders(spark: SparkSession, root: str, month: str) -> dict[str, str]:
    """Folders that hold a month's rows, by version and kind; the empty name is the month's own folder."""
    seen = visible(spark, root, month)
    folders = {f"{m.version}.{kind}": rows_folder(root, m.version, kind, month) for m in seen for kind in SHOWN}
    if not any(m.kind == REPLACE for m in seen):
        folders[""] = f"{root.rstrip('/')}/{_MONTH}{month}"
    return {version: folder for version, folder in folders.items() if exists(spark, folder)}


def all_months(spark: SparkSession, root: str) -> list[str]:
    return sorted({*months_in(spark, root), *months_in(spark, published_folder(root))})
