from __future__ import annotations

import math
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopfunnel.operators import profile
from shopfunnel.operators.quantiles import column_statistics, exact_stats, numeric_stats

ROWS = [
    (1, 2.0, "a", "x"),
    (2, 2.0, "b", None),
    (2, 2.0, "b", None),
    (10, None, None, "y"),
    (7, float("nan"), "a", "y"),
    (7, 0.0, "c", "y"),
    (7, -0.0, "c", "y"),
]
SCHEMA = "id bigint, price double, kind string, note string"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def frame():
    return pd.DataFrame(ROWS, columns=["id", "price", "kind", "note"])


def close(a, b):
    missing = [x is None or math.isnan(x) for x in (a, b)]
    return all(missing) if any(missing) else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_shape_and_info(table):
    assert tuple(profile.shape(table).first()) == (7, 4)
    assert [tuple(r) for r in profile.info(table).orderBy("position").collect()] == [
        (0, "id", "bigint", 7),
        (1, "price", "double", 6),
        (2, "kind", "string", 6),
        (3, "note", "string", 5),
    ]


def test_missing(table):
    assert [tuple(r) for r in profile.missing(table).collect()] == [("note", 2), ("kind", 1), ("price", 1), ("id", 0)]


def test_numeric_summary_is_that_of_pandas(table, frame):
    expected = frame.describe()
    found = {r.column_name: r for r in profile.numeric_summary(table).collect()}
    assert set(found) == {"id", "price"}
    for column, row in found.items():
        ours = [row["count"], row["mean"], row["std"], row["min"], row.p25, row.p50, row.p75, row["max"]]
        assert all(close(a, b) for a, b in zip(ours, expected[column], strict=True)), (column, ours)


def test_text_summary(table):
    found = {r.column_name: tuple(r)[1:] for r in profile.text_summary(table).collect()}
    assert found == {"kind": (6, 3, "a", 2), "note": (5, 2, "y", 4)}


def test_columns_without_values(spark):
    empty = spark.createDataFrame([(None, None)], "n double, s string")
    assert tuple(profile.numeric_summary(empty).first()) == ("n", 0, *[None] * 7)
    assert tuple(profile.text_summary(empty).first()) == ("s", 0, 0, None, None)
    assert tuple(profile.numeric_summary(empty.limit(0)).first()) == ("n", 0, *[None] * 7)


def test_distinct(table, frame):
    expected = {"id": 4, "price": 3, "kind": 3, "note": 2}  # NaN is a value of its own in Spark
    for approximate in (False, True):
        rows = profile.distinct_counts(table, approximate=approximate).collect()
        assert {r.column_name: r.distinct_values for r in rows} == expected
        assert [r.distinct_values for r in rows] == sorted(expected.values())


def test_duplicates(table, frame):
    assert profile.duplicate_rows(table).first().duplicate_rows == 2 == frame.duplicated().sum()
    assert profile.duplicate_rows(table.limit(0)).first().duplicate_rows == 0


def test_head_and_tail(table):
    keys = ["id", "kind"]
    assert [r.id for r in profile.head(table, keys, 2).collect()] == [1, 2]
    assert [(r.id, r.kind) for r in profile.tail(table, keys, 2).collect()] == [(10, None), (7, "c")]


def test_event_mix(spark):
    events = spark.createDataFrame([("view",)] * 6 + [("cart",), (None,)], "event_type string")
    found = {r.event_type: (r.events, r.share) for r in profile.event_mix(events).collect()}
    assert found == {"view": (6, 75.0), "cart": (1, 12.5), None: (1, 12.5)}


def test_event_ratios(spark):
    events = spark.createDataFrame([("view",)] * 8 + [("cart",)] * 2, "event_type string")
    assert tuple(profile.event_ratios(events).first()) == (8, 2, 0, 25.0, 0.0)


NUMBERS = st.one_of(
    st.floats(-1e9, 1e9, allow_nan=False), st.sampled_from([0.0, 1.0, 1.0, float("nan")]), st.none()
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(NUMBERS, st.integers(-(10**6), 10**6)), min_size=1, max_size=200),
    st.integers(2, 40),
)
def test_statistics_are_exact_for_any_number_of_buckets(spark, rows, buckets):
    probabilities = (0.0, 0.1, 0.5, 0.99, 1.0)
    df = spark.createDataFrame(rows, "a double, b bigint")
    found = {r.column_name: r for r in numeric_stats(df, ["a", "b"], probabilities, buckets).collect()}
    for i, column in enumerate("ab"):
        values = np.array([r[i] for r in rows if r[i] is not None and not math.isnan(r[i])], dtype=float)
        row = found[column]
        assert row["count"] == len(values)
        if len(values):
            assert np.allclose(row["quantiles"], np.quantile(values, probabilities), rtol=1e-9, atol=1e-9)
            assert close(row["mean"], values.mean()) or abs(row["mean"] - values.mean()) < 1e-3
            assert (row["min"], row["max"]) == (values.min(), values.max())
        if len(values) > 1:
            assert math.isclose(row["std"], values.std(ddof=1), rel_tol=1e-6, abs_tol=1e-6)
        else:
            assert row["std"] is None


def test_a_value_that_fills_the_column(spark):
    df = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, id, 5) as v")
    row = numeric_stats(df, ["v"], (0.25, 0.5, 0.9)).first()
    values = np.array([i if i % 3 == 0 else 5 for i in range(30_000)], dtype=float)
    assert row["quantiles"] == list(np.quantile(values, (0.25, 0.5, 0.9)))


def exactly(values, probability):
    """The quantile by rational numbers."""
    at = Fraction(str(probability)) * (len(values) - 1)
    low, high = (sorted(values)[f(at)] for f in (math.floor, math.ceil))
    return Fraction(low) + (Fraction(high) - Fraction(low)) * (at - math.floor(at))


def neighbours_near(start, n):
    """Whole numbers that no double tells from their neighbours, and a few far away."""
    draw = random.Random(start)
    return [start + draw.randrange(3 * n) for _ in range(n)] + [-(2**63), 2**63 - 1, 0, 0, 0]


@pytest.mark.parametrize("buckets, most", [(2, 1), (2, 3), (5, 10), (256, 10**6)])
def test_long_ids_come_back_intact_whatever_one_task_may_sort(spark, buckets, most):
    ids = neighbours_near(10**18 + 1, 120)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    row = exact_stats(df, ["id"], (0.0, 0.25, 0.5, 0.75, 1.0), buckets, most).first()
    assert (row["count"], row["min"], row["max"]) == (len(ids), min(ids), max(ids))
    assert [Fraction(q) for q in row["quantiles"]] == [exactly(ids, p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]


@pytest.mark.parametrize("most", [1, 7, 10**6])
def test_decimals_keep_their_digits(spark, most):
    draw = random.Random(3)
    values = [Decimal(draw.randrange(10**6)).scaleb(-9) + Decimal("123456789012345678901") for _ in range(90)]
    df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(values)], "v decimal(31,9), i int")
    found = {r.column_name: r for r in exact_stats(df, ["v", "i"], (0.25, 0.5), 4, most).collect()}
    assert [Fraction(q) for q in found["v"]["quantiles"]] == [exactly(values, p) for p in (0.25, 0.5)]
    assert [Fraction(q) for q in found["i"]["quantiles"]] == [exactly([i % 5 for i in range(90)], p) for p in (0.25, 0.5)]


def test_no_task_sorts_more_values_than_allowed(spark, monkeypatch):
    """Of 4,000 distinct values, a tenth of them too close for doubles, leaves hold 20 at most."""
    from shopfunnel.operators import quantiles

    leaves = []
    kept = quantiles._sorted_out
    monkeypatch.setattr(quantiles, "_sorted_out", lambda f, found: leaves.extend(found) or kept(f, found))
    ids = [i * 10**14 for i in range(3_600)] + [9 * 10**18 + i for i in range(400)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    (stats,) = column_statistics(df, ["id"], (0.1, 0.5, 0.95, 0.999), 8, 20)
    assert leaves and all(1 < leaf.rows <= 20 for leaf in leaves)
    assert [n[1] for n in stats.neighbours] == [sorted(ids)[math.floor(Fraction(p) * 3999)] for p in ("0.1", "0.5", "0.95", "0.999")]


def test_exact_summary_of_odd_tables(spark):
    empty = spark.createDataFrame([(None, None)], "n bigint, d decimal(10,2)")
    for table in (empty, empty.limit(0)):
        assert [tuple(r) for r in profile.exact_summary(table).collect()] == [(c, 0, *[None] * 5) for c in "nd"]
    with pytest.raises(ValueError, match="price"):
        exact_stats(spark.createDataFrame([(1.5,)], "price double"), ["price"], (0.5,))
    assert profile.exact_summary(spark.createDataFrame([("a",)], "s string")).count() == 0
    wide = spark.createDataFrame([(Decimal("1.5"), 2)], "d decimal(38,18), n bigint")
    assert [r.column_name for r in profile.exact_summary(wide).collect()] == ["n"]
    assert {r.column_name: r.p50 for r in profile.numeric_summary(wide).collect()} == {"d": 1.5, "n": 2.0}


def test_infinite_values(spark):
    df = spark.createDataFrame([(float(v),) for v in ("-inf", "inf", "1", "2", "3")], "v double")
    row = numeric_stats(df, ["v"], (0.0, 0.5, 1.0)).first()
    assert (row["min"], row["quantiles"], row["max"]) == (-math.inf, [-math.inf, 2.0, math.inf], math.inf)


def test_work_tables_of_statistics_are_deleted(spark):
    from shopfunnel.session import entries, work_path

    folder = work_path(spark, "x").rsplit("/", 1)[0]
    before = set(entries(spark, folder))
    profile.numeric_summary(spark.range(50).toDF("v")).collect()
    assert set(entries(spark, folder)) == before
