"""Every catalog query with a SQL twin gives the same rows on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, difference, duck_result, spark_result

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()



@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    got = spark_result(entry_module.queries()[name](spark, SF_DIR))
    assert difference(got, duck_result(con, ORACLES[name])) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_module.queries())
