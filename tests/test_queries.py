"""Every query against its SQL counterpart on the smallest tables."""

import pytest
from conftest import DATA
from oracle import connect, difference

import __spark_entry__ as entry_point

QUERIES = entry_point.QUERIES
ORACLES = entry_point.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, DATA), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["cell", "year", "mean_value", "n"]
    assert df.count() > 0
