from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shopfunnel.llm import negatives
from shopfunnel.llm.negatives import mine, pack, unpack

SCHEMA = "vec_id long, embedding array<float>, label int, row string, key int"


def brute(rows, every, positives=5, wanted=3, low=50, high=95, scale=256):
    """All pairs of all rows; rows repeating an id must be equal for this to be defined."""
    usable = [
        (i, label, tuple(math.floor(scale * float(np.float32(x))) for x in v))
        for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = Counter()
    for a, (anchor, label, x) in enumerate(usable):
        if anchor % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i, own == label) for b, (i, own, y) in enumerate(usable) if b != a and len(y) == len(x)]
        scored.sort()
        for minus, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [(-m, i) for m, i, alike in scored if not alike and low * -minus <= 100 * -m <= high * -minus]
            for rank, (score, negative) in enumerate(inside[:wanted], 1):
                found[anchor, positive, rank, negative, -minus, score] += 1
    return found


def ours(spark, rows, every):
    df = spark.createDataFrame([(i, v, label, "other", 1) for i, v, label in rows], SCHEMA).repartition(3)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r[n] for n in names) for r in mine(df, anchors_every=every).collect())


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(k, (rng.integers(-2, 3, 4) / 4).tolist(), int(rng.integers(3))) for k in range(-40, 160)]
    rows += [(k, [0.5, 0.5, 0.0, 0.0], k % 2) for k in range(300, 360)]  # ties
    rows += [(k, [0.0] * 4, k % 3) for k in range(400, 420)]  # scores of 0
    rows += [(k, [1.0, 2.0], k % 2) for k in range(500, 515)] + [(k, [], k % 2) for k in range(600, 612)]
    rows += [(701, [1.0, 0.5, 0.0, 0.0], 1)] * 3 + [(700, [1.0, 0.25, 0.0, 0.0], 1)] * 2
    rows += [(None, [1.0] * 4, 1), (710, None, 1), (720, [1.0] * 4, None), (730, [None, 1.0, 1.0, 1.0], 1)]
    return rows + [(740, [math.nan, 1.0, 1.0, 1.0], 1), (750, [math.inf, 1.0, 1.0, 1.0], 1)]


@pytest.mark.parametrize("groups", [(8192, 4096), (16, 8)])
def test_equals_brute_force_with_odd_rows(spark, monkeypatch, groups):
    """In one cell, and in many; blocks of a few pairs."""
    monkeypatch.setattr(negatives, "GROUP_ROWS", groups[0])
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", groups[1])
    rows = odd_rows()
    expected = brute(rows, 10)
    assert ours(spark, rows, 10) == expected
    assert any(key[4] == 0 for key in expected)


def test_large_components(spark):
    rng = np.random.default_rng(8)
    for size in (2.0**12, 2.0**17):
        rows = [(k, (rng.normal(1, 0.5, 3) * size).tolist(), k % 3) for k in range(60)]
        assert ours(spark, rows, 10) == brute(rows, 10)
    with pytest.raises(Exception, match="62 bits"):
        ours(spark, [(k, [2.0**22, 1.0, 1.0], k % 2) for k in range(30)], 10)


def test_empty_tables(spark):
    assert mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ours(spark, [(k, [1.0], k % 2) for k in range(1, 9)], 10) == Counter()


INTS = st.integers(-(2**62), 2**62)


@given(st.lists(st.tuples(st.integers(0, 2**63 - 1), INTS, st.integers(-(2**63), 2**63 - 1), st.integers(0, 2**63 - 1)), max_size=30))
def test_keys_sort_like_what_they_hold(records):
    assert [unpack(pack(*r)) for r in records] == records
    order = lambda r: (r[0], -r[1], r[2], r[3])
    assert [tuple(unpack(k)) for k in sorted(pack(*r) for r in records)] == sorted(records, key=order)
