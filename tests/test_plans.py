"""Plan-level guards for the scale properties (no regressions to all-pairs or row UDFs)."""

import re

import pytest

from support import SF_SMALL
from keyflow.operators import running_count
from keyflow.plans.queries import BATCH_QUERIES
from keyflow.sources import load


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_cartesian_nested_loop_or_row_udf(spark, name):
    plan = plan_of(BATCH_QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{name} uses {bad}"


@pytest.mark.parametrize("name", ["text_lengths", "length_filter", "behavior_rejects"])
def test_maps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(BATCH_QUERIES[name](spark, SF_SMALL))


def test_behavior_lines_are_split_once(spark):
    assert len(re.findall(r"split\(", plan_of(BATCH_QUERIES["behavior_counts"](spark, SF_SMALL)))) == 1


def test_word_count_prunes_columns_and_pre_aggregates(spark):
    plan = plan_of(BATCH_QUERIES["word_count"](spark, SF_SMALL))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["text:string"]
    assert "partial_count" in plan


def test_chunked_scan_partitions_window_by_key_and_chunk(spark):
    ev = load(spark, SF_SMALL, "events").select("event_id", "ts", "user_id")
    plan = plan_of(running_count(ev, ["user_id"], ["ts", "event_id"], rows_per_chunk=50))
    assert re.search(r"hashpartitioning\(_kf_key#\d+, _kf_chunk#\d+", plan)
    # the un-chunked plan would partition by the user alone
    assert not re.search(r"Exchange hashpartitioning\(user_id#\d+L, \d+\)", plan)


def test_cooccurrence_never_joins_on_the_user(spark):
    plan = plan_of(BATCH_QUERIES["item_cooccurrence"](spark, SF_SMALL))
    for m in re.finditer(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^\]]*)\]", plan):
        assert "_u" not in m.group(2) and "o_custkey" not in m.group(2)
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_chunked_join_reuses_the_window_partitioning_without_broadcast(spark):
    """When the summary is too big to broadcast, the big side must not be shuffled twice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = load(spark, SF_SMALL, "events").select("event_id", "ts", "user_id")
        plan = plan_of(running_count(ev, ["user_id"], ["ts", "event_id"], rows_per_chunk=50))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[_kf_key#\d+, _kf_chunk#\d+\]", plan)
    big_side = plan.split("SortMergeJoin")[1].split("FileScan")[0]
    assert big_side.count("Exchange") == 1          # the window's exchange, reused by the join
    assert "coalesce(" not in " ".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan))
