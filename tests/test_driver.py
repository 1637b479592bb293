from __future__ import annotations

import pytest

import __spark_entry__ as driver
from oracle import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
    assert df.count() > 0


def test_every_query_has_its_sql():
    assert driver.REGISTRY.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(driver.REGISTRY))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    assert differences(driver.queries()[name](spark, sf_dir), con, driver.oracle_sql()[name]) == []
