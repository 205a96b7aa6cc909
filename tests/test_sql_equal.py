"""Every query with a check must give the rows of its SQL."""

import os

import pytest
from check_sql import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("TABULON_SF", "/root/testdata/sf0.001")
RUN, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal(spark, con, name):
    rows, problems = compare(RUN[name](spark, SF), con, SQL[name])
    assert not problems


def test_every_check_has_a_query():
    assert set(SQL) <= set(RUN)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "SK_ID_CURR" and df.count() > 0
