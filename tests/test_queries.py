"""Every registered query against its SQL twin, at the smallest scale."""

import pytest
from compare import compare, duck_connection

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    run = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert run(spark, SF).count() > 0
        return
    ok, text = compare(spark, con, run, sql, SF)
    assert ok, text


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
