"""Every named query against its SQL counterpart on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from tallyhouse.plans import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        same, note = compare(df, con, sql)
        assert same, note


def test_every_sql_has_a_query():
    from tallyhouse.plans import SQL

    assert set(SQL) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
