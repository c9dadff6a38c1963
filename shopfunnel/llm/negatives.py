"""Hard negatives for anchors: rows of other labels that score little below a row of the own label.

A score is the inner product of integer vectors, and exact. Anchors and rows are dealt out to groups
of bounded size, and the pairs of groups are cells that tasks score by themselves. A pair of rows
becomes a record only where it can matter: of an anchor's rows of its own label a cell gives the
highest few, and of the others, once the positives are known, the highest few in each positive's
window. Records are packed into keys of (anchor, descending score, id), sorted within partitions
during the shuffle, and a task reads an anchor's records as a stream: a positive opens a window, a
negative is handed to every open window it lies in, and no anchor's records are held.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm.common import result, saved, scratch
from shopfunnel.session import sized_shuffle

#: Positives of an anchor, negatives of a positive, and the window in per cent of the positive's score.
POSITIVES = 5
NEGATIVES = 3
LOW = 50
HIGH = 95
SCALE = 256
#: Rows and anchors of a group, on average.
GROUP_ROWS = 8192
GROUP_ANCHORS = 4096
#: Pairs scored at a time, and records a partition sorts, on average.
_PAIRS = 1 << 20
_RECORDS = 2_000_000
#: Bytes of a row on its way to a cell, about.
_ROW_BYTES = 320
#: (anchor, inverted score, id, row): byte order is that of the tuple.
_KEY = struct.Struct(">QQQQ")
_SIGN = 1 << 63


class Record(NamedTuple):
    """A row met by an anchor."""

    anchor: int
    score: int
    id: int
    row: int


def pack(anchor: int, score: int, row_id: int, row: int) -> bytes:
    """A key whose bytes sort by anchor, then from high to low score, then by id and row."""
    return _KEY.pack(anchor, _SIGN - 1 - score, row_id + _SIGN, row)


def unpack(key: bytes) -> Record:
    anchor, score, row_id, row = _KEY.unpack(key)
    return Record(anchor, _SIGN - 1 - score, row_id - _SIGN, row)


def in_window(positive: int, negative: int, low: int = LOW, high: int = HIGH) -> bool:
    return low * positive <= 100 * negative <= high * positive


def sorted_by_key(records: RDD, parts: int) -> RDD:
    """``(key, value)`` records, those of one anchor in one partition and in order there."""
    return records.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))


def highest(records: Iterable[tuple[bytes, object]], n: int) -> Iterator[tuple[bytes, object]]:
    """Of sorted records, the first ``n`` of each anchor."""
    anchor, met = None, 0
    for key, value in records:
        if key[:8] != anchor:
            anchor, met = key[:8], 0
        if met < n:
            yield key, value
        met += 1


def mined(
    records: Iterable[tuple[bytes, bool]], positives: int, negatives: int, low: int, high: int
) -> Iterator[tuple[int, Record, int, Record]]:
    """``anchor, positive, rank, negative`` from sorted records; the value tells positives.

    A record is looked at once. Held are an anchor's open windows, and the first few negatives of
    score 0: a positive of score 0 that follows them by its id has them in its window, the only
    one that can hold what comes before it.
    """
    anchor, opened, windows, zeros = None, 0, [], []
    for key, positive in records:
        met = unpack(key)
        if met.anchor != anchor:
            anchor, opened, windows, zeros = met.anchor, 0, [], []
        if positive:
            if opened == positives:
                continue
            opened += 1
            window = [met, 0]
            for earlier in zeros if met.score == 0 else ():
                window[1] += 1
                yield anchor, met, window[1], earlier
            windows.append(window)
            continue
        if met.score == 0 and len(zeros) < negatives:
            zeros.append(met)
        for window in windows:
            if window[1] < negatives and in_window(window[0].score, met.score, low, high):
                window[1] += 1
                yield anchor, window[0], window[1], met


def mine(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    anchors_every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null id, label or vector, or a null or non-finite component take no part; components
    become ``floor(scale * x)``. Anchors are the rows whose id is divisible by ``anchors_every``. An
    anchor's positives are the first of the other rows of its label by descending score, then by id;
    for each, the first rows of other labels whose score lies from ``low`` to ``high`` per cent of the
    positive's are its negatives, ranked from 1. All if there are fewer. Rows repeating an id are
    rows of their own, as anchors too, ordered by their place in the work table. Vectors of
    different lengths have no score and never meet; empty ones score 0. An empty table, or one
    without anchors, gives an empty result. Components beyond 32 bits, and vectors whose scores may
    not fit 62 bits, raise. Other columns are not read.
    """
    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType.simpleString()
    with scratch(spark):
        known = saved(_numbered(_usable(rows, id_col, vector_col, label_col, scale)), "vectors")
        n_rows = known.count()
        anchors = known.filter(F.col("id") % anchors_every == 0)
        n_anchors = anchors.count()
        grid = _Grid(max(1, math.ceil(n_anchors / GROUP_ANCHORS)), max(1, math.ceil(n_rows / GROUP_ROWS)))
        records = n_anchors * grid.down * positives * negatives
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(records / _RECORDS))
        moved = (n_rows * grid.across + n_anchors * grid.down) * _ROW_BYTES
        with sized_shuffle(spark, moved):
            own = grid.cells(anchors, known, _positive_cell(positives), "key binary")
            ranked = sorted_by_key(_keyed(own), parts).mapPartitions(lambda part: highest(part, positives))
            found = ranked.map(lambda r: (r[0], unpack(r[0]).anchor, unpack(r[0]).score))
            found = saved(spark.createDataFrame(found, "key binary, row long, score long"), "positives")
            scores = found.groupBy("row").agg(F.array_sort(F.collect_list("score")).alias("scores"))
            others = grid.cells(anchors.join(scores, "row"), known, _negative_cell(negatives, low, high), "key binary")
            both = _keyed(found, True).union(_keyed(others))
            triples = sorted_by_key(both, parts).mapPartitions(lambda part: mined(part, positives, negatives, low, high))
            flat = triples.map(lambda t: (t[0], t[1].id, t[2], t[3].id, t[1].score, t[3].score))
            schema = "row long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
            named = spark.createDataFrame(flat, schema).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            ids = [F.col(c).cast(id_type).alias(c) for c in ("anchor_id", "positive_id", "negative_id")]
            return result(named.select(*ids, "rank", "positive_score", "negative_score"), "hard-negatives")


def _usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    vector = F.col("vector")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    kept = named.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & whole)
    return kept.select("id", F.col("label").cast("string").alias("label"), F.transform(vector, lambda x: F.floor(scale * x).cast("int")).alias("x"))


def _numbered(rows: DataFrame) -> DataFrame:
    """With ``row``, a number of its own for each row; written before it is used, so it stays."""
    return rows.withColumn("row", F.monotonically_increasing_id())


class _Grid(NamedTuple):
    """Groups of anchors against groups of rows."""

    across: int
    down: int

    def cells(self, anchors: DataFrame, rows: DataFrame, run, schema: str) -> DataFrame:
        """``run(anchors, rows)`` of each cell, Arrow tables both.

        Rows are dealt to groups by their numbers' hash, so groups are alike in size whatever ids,
        labels or vectors repeat, and each side is sent once for each group of the other.
        """
        own = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # both sides come from one table
        left = own.withColumn("a", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(self.across)))
        left = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(self.down - 1)).cast("array<long>")))
        right = rows.withColumn("b", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(self.down)))
        right = right.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(self.across - 1)).cast("array<long>")))
        return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(run, schema)


def _keyed(df: DataFrame, value: bool = False) -> RDD:
    return df.select("key").rdd.map(lambda r: (bytes(r[0]), value))


class _Rows(NamedTuple):
    """Rows of one length of vector, by id and number."""

    id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    x: np.ndarray

    def take(self, places: np.ndarray) -> _Rows:
        return _Rows(*(v[places] for v in self))


def _by_length(table: pa.Table, codes: dict[str, int]) -> dict[int, _Rows]:
    lists = table.column("x").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy()
    ids, rows = table.column("id").to_numpy(), table.column("row").to_numpy()
    labels = np.array([codes.setdefault(v, len(codes)) for v in table.column("label").to_pylist()], dtype=np.int64)
    found = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        at = at[np.lexsort((rows[at], ids[at]))]
        x = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), size)
        found[size] = _Rows(ids[at], rows[at], labels[at], x)
    return found


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in a type in which their products are exact."""
    top = [max(-int(m.min()), int(m.max()), 1) if m.size else 1 for m in (a, b)]
    most = top[0] * top[1] * max(a.shape[1], 1)
    if most >= 1 << 55:  # times 100 it has to fit 62 bits
        raise OverflowError("scores may not fit 62 bits")
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return a.astype(kind), b.astype(kind)


def _scored(anchors: _Rows, rows: _Rows) -> Iterator[tuple[_Rows, np.ndarray]]:
    """Some anchors at a time with their scores."""
    left, right = _exact(anchors.x, rows.x)
    right = np.ascontiguousarray(right.T)
    step = max(1, _PAIRS // max(1, len(rows.id)))
    for low in range(0, len(anchors.id), step):
        yield anchors.take(slice(low, low + step)), left[low : low + step] @ right


def _keys(anchors: np.ndarray, scores: np.ndarray, rows: _Rows, places: np.ndarray) -> list[bytes]:
    columns = (anchors.tolist(), scores.astype(np.int64).tolist(), rows.id[places].tolist(), rows.row[places].tolist())
    return [pack(*values) for values in zip(*columns)]


def _cell(left: pa.Table, right: pa.Table) -> Iterator[tuple[_Rows, _Rows]]:
    codes: dict[str, int] = {}
    others = _by_length(right, codes)
    for size, anchors in _by_length(left, codes).items():
        if size in others:
            yield anchors, others[size]


def _positive_cell(positives: int):
    """The highest rows of the anchors' own labels in a cell."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys: list[bytes] = []
        for anchors, rows in _cell(left, right):
            for label in np.unique(anchors.label):
                alike = rows.take(np.flatnonzero(rows.label == label))
                if not len(alike.id):
                    continue
                for some, scores in _scored(anchors.take(np.flatnonzero(anchors.label == label)), alike):
                    least = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
                    scores[some.row[:, None] == alike.row[None, :]] = least  # a row is not its own positive
                    each = np.arange(len(some.id))
                    for _ in range(min(positives, len(alike.id))):
                        best = scores.argmax(axis=1)  # of equal scores the first, which has the smallest id
                        value = scores[each, best]
                        ok = value > least
                        keys += _keys(some.row[ok], value[ok], alike, best[ok])
                        scores[each, best] = least
        return pa.table({"key": pa.array(keys, pa.binary())})

    return run


def _negative_cell(negatives: int, low: int, high: int):
    """The highest rows of other labels in each window of the anchors of a cell."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys: list[bytes] = []
        windows = dict(zip(left.column("row").to_pylist(), left.column("scores").to_pylist()))
        for anchors, rows in _cell(left, right):
            for some, scores in _scored(anchors, rows):
                least = np.array([min(windows[r]) for r in some.row.tolist()])
                most = np.array([max(windows[r]) for r in some.row.tolist()])
                # the smallest and the largest integer any window of the anchor holds
                least, most = (v.astype(scores.dtype)[:, None] for v in (-(-low * least // 100), high * most // 100))
                may = (scores >= least) & (scores <= most)
                may &= some.label[:, None] != rows.label[None, :]
                which, places = np.nonzero(may)
                values = scores[which, places].astype(np.int64)
                order = np.lexsort((places, -values, which))  # places are in order of the ids
                which, places, values = which[order], places[order], values[order]
                bounds = np.searchsorted(which, np.arange(len(some.id) + 1))
                for k in np.flatnonzero(np.diff(bounds)).tolist():
                    a, b = bounds[k], bounds[k + 1]
                    down = -values[a:b]
                    wanted = set()
                    for positive in windows[int(some.row[k])]:
                        first = np.searchsorted(down, -(high * positive // 100))
                        after = np.searchsorted(down, low * positive // -100, side="right")
                        wanted.update(range(a + first, a + min(after, first + negatives)))
                    chosen = np.array(sorted(wanted), dtype=np.int64)
                    keys += _keys(np.full(len(chosen), some.row[k]), values[chosen], rows, places[chosen])
        return pa.table({"key": pa.array(keys, pa.binary())})

    return run
