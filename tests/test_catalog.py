"""Every registered query against its SQL, row by row, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from nightgrid.catalog import QUERIES, SQL
from tests.oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, key):
    assert differences(spark, con, QUERIES[key], SQL[key], SF_DIR) == []


def test_entry(spark):
    assert entry(spark).count() > 0
