"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from tallyloom.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMOKE_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(QUERIES) & set(oracle_sql()) & set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SMOKE_DIR), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
