from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra.numpy import arrays

from shopfunnel.llm.centroids import LARGEST, centroid_digest, choose_pivots, cluster_vectors, nearest

SCHEMA = "vec_id long, embedding array<float>, x string, cluster int"


def brute(rows, dims, clusters, rounds, scale, seed=3):
    """Plain clustering with Python's integers; no pivots."""
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    assign = lambda: [min((square(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, best) in zip(kept, found) if best == j]
            if own:
                centroids[j] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    totals = Counter()
    for d, j in found:
        totals[j] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, totals[j], sum(totals.values()), digests[j]) for (i, _), (d, j) in zip(kept, found))


def ours(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "other", 1) for i, v in rows], SCHEMA).repartition(3)
    found = cluster_vectors(df, **options).withColumn("sha", centroid_digest())
    return Counter((r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.sha) for r in found.collect())


def test_equals_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(rng.integers(3), 0.3, 4).tolist()) for k in range(120)]
    rows += [(k, [0.25, -0.25, 0.5, 0.0]) for k in range(200, 260)]  # one vector many times
    rows += [(7, rows[7][1]), (7, [1.0, 2.0, 3.0, 4.0]), (None, [0.0] * 4), (None, [0.0] * 4)]
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0] * 5), (304, [1.0, None, 1.0, 1.0])]
    rows += [(305, [math.nan, 0.0, 0.0, 0.0]), (306, [0.0, math.inf, 0.0, 0.0]), (307, [0.0, -math.inf, 0.0, 0.0])]
    options = {"dims": 4, "clusters": 5, "rounds": 4, "scale": 8}
    assert ours(spark, rows, **options) == brute(rows, **options)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_clusters(spark, n):
    rows = [(k, [float(k), 1.0]) for k in range(n)] + [(9, None)]
    options = {"dims": 2, "clusters": 5, "rounds": 2, "scale": 4}
    assert ours(spark, rows, **options) == brute(rows, **options)


def test_empty_table_and_components_too_large(spark):
    assert cluster_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(OverflowError):
        ours(spark, [(1, [1e30, 0.0])], dims=2)


@settings(max_examples=60, deadline=None)
@given(
    arrays(np.int64, (30, 3), elements=st.integers(-4, 4) | st.integers(-LARGEST, LARGEST)),
    arrays(np.int64, (6, 3), elements=st.integers(-4, 4) | st.integers(-LARGEST, LARGEST)),
)
def test_bounds_never_lose_the_nearest(x, centroids):
    pivots = choose_pivots(x[:10], 3)
    cluster, distance, computed = nearest(x, pivots.distances(x), centroids, pivots)
    all_of_them = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == all_of_them.argmin(axis=1)).all() and (distance == all_of_them.min(axis=1)).all()
    assert len(x) <= computed <= all_of_them.size


def test_bounds_save_distances():
    rng = np.random.default_rng(4)
    centroids = rng.integers(-1000, 1000, (8, 6)) * 100
    x = centroids[rng.integers(0, 8, 2000)] + rng.integers(-20, 20, (2000, 6))
    pivots = choose_pivots(x[:64], 12)
    assert nearest(x, pivots.distances(x), centroids, pivots)[2] < 1.1 * len(x)
