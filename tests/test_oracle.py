"""Every registered query against its SQL on the smallest given tables."""

import pytest
from compare import database, difference
from conftest import SF_DIR

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, name, QUERIES[name], ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 15
