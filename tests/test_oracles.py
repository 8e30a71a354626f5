"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(duck, df, sql) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
