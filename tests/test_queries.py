"""Every query with SQL gives the rows its SQL gives on the same tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import database, difference


@pytest.fixture(scope="module")
def sql(folder):
    return database(folder)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, folder, sql, name):
    ours = contract.queries()[name](spark, folder).toPandas()
    theirs = sql.execute(contract.oracle_sql()[name]).df()
    assert len(theirs) > 0
    assert difference(ours, theirs) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_returns_rows(spark, folder, name):
    assert contract.queries()[name](spark, folder).count() > 0


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
