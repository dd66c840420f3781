"""Every query against its SQL, names, types and values."""

import os

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from weirstone.catalog import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], FOLDER) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_is_the_flat_route_calls(spark):
    rows = entry(spark)
    assert len(rows.columns) == 22
    assert rows.count() == 1000
