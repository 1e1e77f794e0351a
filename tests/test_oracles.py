"""Every registered query runs; those with SQL give exactly the SQL's rows."""

import pytest
from checking import database, differences
from conftest import DATA

from roadspark import plans

QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(DATA)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["hour", "predicted_demand", "confidence_low", "confidence_high"]
