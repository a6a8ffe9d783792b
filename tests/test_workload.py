"""Every registered query against its SQL, or for rows where SQL cannot say it."""

import pytest

import __spark_entry__ as entry_point
import oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


def test_names():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
