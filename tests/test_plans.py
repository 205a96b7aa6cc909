"""Plans: what is read, what runs in Python, and what would end up in one task."""

import pytest

from __spark_entry__ import queries

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_the_wanted_columns(spark):
    text = plan(queries()["src2"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double,l_shipdate:timestamp_ntz>" in text


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan(queries()["prj9"](spark, SMALL))


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["ord2"](spark, SMALL))


def test_first_rows_per_group_are_cut_before_the_shuffle(spark):
    assert plan(queries()["win13"](spark, SMALL)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["fea1", "fea9", "fea10", "fea14", "agg17", "evl4", "seq3", "sta4", "win5", "prf1"])
def test_core_jobs_stay_out_of_python(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", ["win2_rows", "win5", "win10", "win11", "evl6", "seq1", "sta9", "prj27"])
def test_no_cross_join_and_no_single_partition_rows(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if "Window [" in line and "windowspecdefinition(" in line and "_l_" in line:
            assert "_range" in line
