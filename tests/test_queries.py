"""Every query of the core against its SQL; those without SQL must run."""

import os

import pytest

from filmloom.plans import catalogue
from tests.oracle import DATA, compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    compare(spark, QUERIES[name], SQL[name], con)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.columns
    assert len(df.collect()) > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["source_type", "final", "review", "discard"]
    assert df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
