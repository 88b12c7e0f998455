"""What the physical plans must and must not contain."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest

from millrace.operators.ratelimit import rate_limit
from millrace.plans import catalog, records

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.QUERIES}
# Python runs only here: decisions that depend on earlier decisions, and a handler of the user's.
PYTHON = {"rate_limit", "consume_handler"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_nested_loops_and_no_row_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit"):
        assert bad not in plan
    if name not in PYTHON:
        assert "InPandas" not in plan and "ArrowEvalPython" not in plan


def test_page_is_a_top_k(spark):
    plan = plan_of(QUERIES["page_ingestion"](spark, FOLDER))
    assert plan.startswith("TakeOrderedAndProject(limit=40, offset=20") and "Exchange" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["metrics_window"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    plan = plan_of(QUERIES["page_keyset"](spark, FOLDER))
    assert "LessThanOrEqual(ts," in plan
    plan = plan_of(QUERIES["request_counts"](spark, FOLDER))
    assert "ReadSchema: struct<event_type:string>" in plan
    plan = plan_of(QUERIES["quality_summary"](spark, FOLDER))
    assert "text:string" not in plan


def test_rules_are_broadcast_and_points_stay_put(spark):
    plan = plan_of(QUERIES["threshold_hits"](spark, FOLDER))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_bursts_shrink_before_the_shuffle(spark):
    plan = plan_of(rate_limit(records.request_log(spark, FOLDER)))
    assert "row_number(), 100, Partial" in plan


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("job_fold", "current_state", "ingest_volume", "duration_histogram", "offset_gaps", "reconcile"):
        assert "partial_" in plan_of(QUERIES[name](spark, FOLDER)), name


def test_windows_over_rows_are_cut(spark):
    """No window over the log's messages is partitioned by the partition alone."""
    plan = plan_of(records.envelope(spark, FOLDER))
    rows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert rows and all("_bucket" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in rows)
