"""What the plans must and must not hold."""

import pytest

from emberlog.operators import context, rollup
from emberlog.operators.rank import recent
from emberlog.plans.oracle import ORACLE
from emberlog.plans.queries import QUERIES, now
from emberlog.session import shared_dir
from emberlog.sources import events

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# The model queries train while they are put together; test_oracle runs them.
MODEL = {"batch_scores", "model_quality", "model_roundtrip", "model_record", "burst_quiet"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - MODEL))
def test_no_cross_join_and_no_python_in_queries(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups", "ArrowEvalPython"):
        assert node not in text, node


def test_rollup_reads_only_what_it_counts(spark):
    text = plan(rollup.rollup(events.logs(spark, SF)))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "user_id", "event_type"}
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_context_is_one_shuffle_and_one_sort_after_the_counts(spark):
    text = plan(context.context(rollup.buckets(events.logs(spark, SF)), chunk_rows=0))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Sort [") == 1


def test_top_n_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["top_n_per_hour"](spark, SF))
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(QUERIES["top_scores"](spark, SF))


def test_small_context_is_broadcast_and_logs_are_not_shuffled(spark):
    text = plan(QUERIES["scored_context"](spark, SF))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_time_filter_reaches_the_scan(spark):
    text = plan(recent(events.read(spark, SF), now(spark, SF), 1, ts="ts"))
    assert "DataFilters: [isnotnull(ts" in text and "Subquery" in text


def test_big_context_is_joined_by_shuffles_without_a_broadcast_of_it(spark, monkeypatch):
    monkeypatch.setattr("emberlog.operators.joins.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["scored_context"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" in text and "SortMergeJoin" in text and text.count("BroadcastHashJoin") <= 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name,parse", [("json_adapter", "from_json("), ("text_adapter", "regexp_replace(value")])
def test_a_line_is_parsed_once(spark, sf_dir, name, parse):
    """Types, errors, signatures and levels all follow from one parse."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.replace("from_json(StructField", "from_json(").count(parse) == 1
    assert plan.count("Generate inline") >= 3
