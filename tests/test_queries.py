"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    note, ok = compare(spark, con, SF, QUERIES[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).columns
