"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1400
