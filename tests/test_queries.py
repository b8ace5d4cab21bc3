"""Every registered query against its SQL at the smallest scale."""

import pytest
from compare import connect, differences

import __spark_entry__ as driver
from marlstone.catalog import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in all_queries().items() if q.sql is not None])
def test_query_matches_sql(name, spark, con):
    assert differences(name, all_queries()[name], spark, con, SF) is None


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
