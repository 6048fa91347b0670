"""Properties of the physical plans of the registered batch queries."""

from __future__ import annotations

import re

import pytest

from fleetlens.plans.queries import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))
IN_PYTHON = {"array_round_trip"}
# One ordered sequence over the whole input; cut into runs once the input is large.
ONE_SEQUENCE = {"late_drop", "late_adjust"}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {
        n: QUERIES[n](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for n in BATCH
    }


@pytest.mark.parametrize("name", BATCH)
def test_plan(plans, name):
    plan = plans[name]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert bool(re.search(r"Python|Pandas|InArrow", plan)) == (name in IN_PYTHON)
    single = re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    assert bool(single) == (name in ONE_SEQUENCE)


@pytest.mark.parametrize(
    "name",
    [
        "staging_dedup", "merge_insert", "upsert_latest", "latest_per_device", "device_status",
        "top_per_partition", "counter_rate", "twin_state",
    ],
)
def test_rows_per_key_are_limited_before_the_shuffle(plans, name):
    assert re.search(r"WindowGroupLimit [^\n]*Partial", plans[name])


def test_filters_and_columns_reach_the_scan(plans):
    plan = plans["series_aggregate"]
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan and "LessThan(ts,2024-01-15" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plans["minute_rate_latency"]


def test_sequence_checks_shuffle_rows_once_per_order(plans):
    # One exchange numbers the test rows, one orders them, one adds up.
    assert plans["missing_events"].count("Exchange ") == 3
    assert plans["stored_order_delta"].count("Exchange ") == 2
