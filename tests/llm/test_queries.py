"""Queries of the subpackage against their SQL."""

import os

import pytest

from filmloom import llm
from tests.oracle import DATA, compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_equals_sql(spark, con, name):
    compare(spark, llm.queries()[name], llm.oracle_sql()[name], con)


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql())))
def test_runs(spark, name):
    assert llm.queries()[name](spark, DATA).count() > 0
