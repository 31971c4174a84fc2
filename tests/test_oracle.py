"""Every registered query against its SQL on the given tables."""

import os

import compare
import pytest

import __spark_entry__ as contract
from ledgerlake.checks import queries, sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = queries.QUERIES, sql.statements()


@pytest.fixture(scope="module")
def con():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
