"""Physical-plan properties that matter at scale."""

import re

import pytest
from conftest import SF_SMALL

from portmart.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def q(spark, name):
    return QUERIES[name](spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    p = plan(q(spark, name))
    for op in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert op not in p, f"{name}: {op}"


def test_filter_pushed_to_scan(spark):
    p = plan(q(spark, "filter_equals"))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in p


def test_projection_pruned_at_scan(spark):
    p = plan(q(spark, "project_columns"))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in p


def test_stacked_distincts_are_one_shuffle(spark):
    # dedup -> staging distinct -> fact distinct collapse into one aggregate
    p = plan(q(spark, "fact_table"))
    assert p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["q_size_vs_volume", "q_share_vs_volume", "popular_cities"])
def test_city_dimension_broadcast_fact_not_shuffled_for_join(spark, name):
    p = plan(q(spark, name))
    assert re.search(r"BroadcastHashJoin \[city_code#\d+, state_code#\d+\]", p)
    assert "SortMergeJoin" not in p


@pytest.mark.parametrize("name", ["clean_temperature", "clean_demographics"])
def test_rows_get_their_port_code_by_broadcast(spark, name):
    # the rows are joined to the (name -> code) mapping map-side
    assert re.search(r"BroadcastHashJoin \[lower\(City#\d+\)\]", plan(q(spark, name)))


def test_pivot_is_one_aggregation(spark):
    p = plan(q(spark, "pivot_sum"))
    assert p.count("Exchange") == 1 and "partial_sum" in p


def test_top_k_keeps_k_per_task(spark):
    assert "TakeOrderedAndProject" in plan(q(spark, "top_k"))


def test_lookup_reads_its_rows_once(spark):
    p = plan(q(spark, "lookup_many_names"))
    assert p.count("customer.parquet") == 1 and "BroadcastHashJoin" in p
