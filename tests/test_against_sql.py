"""Every query against the SQL that must give the same rows."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracle import all_sql
from checks.registry import all_queries
from tests.conftest import SAMPLE_FOLDER

QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SAMPLE_FOLDER)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SAMPLE_FOLDER), duck, SQL[name]) == []


def test_flagship(spark):
    result = contract.entry(spark)
    assert result.columns == ["genre", "decade", "avg_rating", "total_ratings"]
    assert not result.isEmpty()
