"""Clustering of integer vectors around centroids, with exact distances behind a pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it. In each
round the centroids' distances to the same pivots are known too, and by the triangle inequality the
largest difference of the two bounds a vector's distance to a centroid from below. A vector's exact
distance is computed to the centroid of the least bound first, then only to those whose bound does
not exceed the best found. Components are integers, so distances, sums and means are exact, and the
result depends neither on the pivots nor on how the vectors are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm.common import result, saved, scratch

#: Clusters, rounds, and what components are multiplied with before they are rounded down.
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Pivots, and the vectors (first in hash order) they are chosen from.
PIVOTS = 12
CANDIDATES = 64
#: Largest magnitude of an integer component: squared distances of 256 of them fit 64 bits.
LARGEST = 1 << 26
#: Vectors compared at a time.
_ROWS = 4096


class Pivots(NamedTuple):
    """Fixed vectors, one a row."""

    vectors: np.ndarray

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Distances of every row of ``x`` to every pivot."""
        squares = [((x - p) ** 2).sum(axis=1) for p in self.vectors]
        return np.sqrt(np.array(squares, dtype=np.float64).reshape(len(self.vectors), len(x)).T)


def choose_pivots(candidates: np.ndarray, n: int = PIVOTS) -> Pivots:
    """Candidates far from each other: each next one has the largest sum of distances to those taken."""
    taken: list[int] = []
    total = np.zeros(len(candidates))
    for _ in range(min(n, len(candidates))):
        total[taken] = -1.0
        taken.append(int(total.argmax()))
        total = total + np.sqrt(((candidates - candidates[taken[-1]]) ** 2).sum(axis=1).astype(np.float64))
    return Pivots(candidates[taken])


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of each row (ties: the smaller), its squared distance, and
    how many exact distances were computed."""
    own = pivots.distances(centroids)
    bound = np.zeros((len(x), len(centroids)))
    for p in range(own.shape[1]):
        a, b = to_pivots[:, p, None], own[None, :, p]
        # less by more than what rounding can add
        np.maximum(bound, np.abs(a - b) - 1e-9 * (a + b), out=bound)
    bound *= bound
    cluster = bound.argmin(axis=1)
    first = cluster.copy()
    best = ((x - centroids[cluster]) ** 2).sum(axis=1)
    computed = len(x)
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero((bound[:, j] <= best * (1 + 1e-9)) & (first != j))
        exact = ((x[rows] - centroid) ** 2).sum(axis=1)
        nearer = (exact < best[rows]) | ((exact == best[rows]) & (j < cluster[rows]))
        best[rows[nearer]], cluster[rows[nearer]] = exact[nearer], j
        computed += len(rows)
    return cluster, best, computed


def cluster_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = 3,
    pivots: int = PIVOTS,
) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector kept.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; components become
    ``floor(scale * x)``. The first centroids are the vectors whose ``seed:<id>`` has the smallest
    sha256, repeated ids ordered by their vectors; fewer vectors than clusters give fewer clusters.
    A null id is kept but starts no cluster unless too few others do. Repeated rows count each. An
    empty table, or one without a vector to keep, gives an empty result. A centroid without vectors
    stays. A component beyond ±2**26 after scaling raises, for squares must fit 64 bits. Other
    columns are not read.

    The driver holds the centroids, the pivots and a sum for each centroid's component.
    """
    if dims > 256:
        raise ValueError("squared distances of more than 256 components may not fit 64 bits")
    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType.simpleString()
    with scratch(spark):
        kept = _kept(rows, id_col, vector_col, dims, scale)
        digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
        drawn = kept.orderBy(digest.asc_nulls_last(), "x").limit(max(CANDIDATES, clusters)).collect()
        if not drawn:
            return spark.createDataFrame([], _RESULT.format(id_type))
        candidates = np.array([r.x for r in drawn], dtype=np.int64)
        _check(candidates)
        fixed, centroids = choose_pivots(candidates, pivots), candidates[:clusters]
        vectors = saved(kept.mapInArrow(_tabled(fixed), f"id {id_type}, x array<long>, to_pivots array<double>"), "pivot-table")
        for _ in range(rounds):
            moved = _moved(vectors, centroids, fixed)
            if (moved == centroids).all():
                break  # every further round would find the same
            centroids = moved
        found = vectors.mapInArrow(_assigned(centroids, fixed), f"id {id_type}, cluster int, distance long")
        found = saved(found, "clusters")
        exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
        totals = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(exact).collect()}
        each = [(j, totals[j], sum(totals.values()), c) for j, c in enumerate(centroids.tolist()) if j in totals]
        last = spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
        joined = found.join(F.broadcast(last), "cluster")  # a row per cluster
        return result(joined.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"), "clustered")


_RESULT = "id {}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"


def centroid_digest(centroid: str = "centroid") -> Column:
    """sha256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)


def _kept(rows: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    vector = F.col("vector")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kept = named.filter((F.size(vector) == dims) & whole)
    return kept.select("id", F.transform(vector, lambda x: F.floor(scale * x)).alias("x"))


def _check(x: np.ndarray) -> None:
    if len(x) and max(-int(x.min()), int(x.max())) > LARGEST:
        raise OverflowError(f"components beyond {LARGEST:,} after scaling")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), _ROWS):
            yield batch.slice(low, _ROWS)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1), kind))


def _tabled(pivots: Pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _matrix(batch.column("x"), np.int64)
            _check(x)
            columns = [batch.column("id"), batch.column("x"), _lists(pivots.distances(x), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "x", "to_pivots"])

    return run


def _nearest(batch: pa.RecordBatch, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = _matrix(batch.column("x"), np.int64)
    cluster, distance, _ = nearest(x, _matrix(batch.column("to_pivots"), np.float64), centroids, pivots)
    return x, cluster, distance


def _assigned(centroids: np.ndarray, pivots: Pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            _, cluster, distance = _nearest(batch, centroids, pivots)
            columns = [batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The means of the centroids' vectors, rounded down; each task sums its own vectors first."""
    k = len(centroids)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for batch in _pieces(batches):
            x, cluster, _ = _nearest(batch, centroids, pivots)
            counts += np.bincount(cluster, minlength=k)
            for j in np.unique(cluster):
                sums[j] += x[cluster == j].sum(axis=0)
        met = np.flatnonzero(counts)
        columns = [pa.array(met, pa.int32()), pa.array(counts[met]), _lists(sums[met], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.select("x", "to_pivots").mapInArrow(summed, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("component", "part"))
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "part")]
    moved = centroids.copy()
    for r in each.groupBy("cluster", "component").agg(*exact).collect():
        moved[r.cluster, r.component] = int(r.part) // int(r.n)
    return moved


