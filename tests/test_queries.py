"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import connection, difference
from plantmart.workload import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.entry(spark).columns) > 10


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(spark, con, name, FOLDER) is None


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)
