"""Plans that must hold at scale."""

from __future__ import annotations

import re

import pytest

from weftline import registry


def plan(frame) -> str:
    """The physical plan before adaptive execution changes it."""
    return frame._jdf.queryExecution().executedPlan().toString()


def query(spark, sf, name):
    return registry.all_queries()[name](spark, sf)


def test_bucket_join_moves_no_rows(spark, sf):
    text = plan(query(spark, sf, "bucket_join"))
    assert "SortMergeJoin" in text
    assert "Exchange" not in text


@pytest.mark.parametrize("name", ["broadcast_join", "inner_join", "left_outer_join", "full_outer_join"])
def test_small_dimension_is_broadcast(spark, sf, name):
    text = plan(query(spark, sf, name))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


def test_reduce_side_join_shuffles_both_sides(spark, sf):
    text = plan(query(spark, sf, "reduce_side_join"))
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_combiner_runs_before_the_shuffle(spark, sf):
    text = plan(query(spark, sf, "combiner_sum"))
    assert "partial_sum" in text
    assert text.index("Exchange") < text.index("partial_sum")  # the tree prints from the result down to the scan


@pytest.mark.parametrize("name", ["top_n_per_group", "get_versions", "key_reverse_timestamp", "column_pagination"])
def test_rank_limits_are_pushed_below_the_shuffle(spark, sf, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan(query(spark, sf, name)))


@pytest.mark.parametrize("name", ["sort_limit_topk", "top_n_words", "wordcount_tokenize", "cross_join", "sample_rows"])
def test_top_k_never_sorts_everything(spark, sf, name):
    text = plan(query(spark, sf, name))
    assert "TakeOrderedAndProject" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_partition_filter_reads_one_folder(spark, sf):
    frame = query(spark, sf, "partition_pruned_scan")
    assert re.search(r"PartitionFilters: \[.*year.*1998.*quarter.*Q2", plan(frame), re.S)


def test_dynamic_partition_pruning(spark, sf):
    assert "dynamicpruning" in plan(query(spark, sf, "dynamic_partition_pruning")).lower()


def test_count_comes_from_footers(spark, sf):
    text = plan(query(spark, sf, "count_from_stats"))
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey), MAX(l_linenumber)]" in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(query(spark, sf, "project_filter_sort"))
    assert "EqualTo(c_mktsegment,BUILDING)" in text and "GreaterThan(c_acctbal,7000.0)" in text
    text = plan(query(spark, sf, "join_group_sum"))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_jdbc_predicate_runs_in_the_database(spark, sf):
    text = plan(query(spark, sf, "jdbc_where_import"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(department,BUILDING\)", text)


def test_cached_branch_is_reused(spark, sf):
    text = plan(query(spark, sf, "cache_reuse"))
    assert text.count("/paid-") == 2 and "customer.parquet" not in text  # both branches read the kept counts
