from __future__ import annotations

import pytest

import __spark_entry__ as entry
from shopfunnel.plans import catalog, oracle
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
