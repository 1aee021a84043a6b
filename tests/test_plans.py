"""Plan-shape regression tests: the physical plans keep the properties the
scale review relies on (one exchange for the wide aggregate, pruned scans,
partial top-k windows, no cartesian or nested-loop joins)."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning)", plan))


def test_daily_features_one_shuffle_and_pruned_scan(spark):
    plan = _plan(spark, "daily_features")
    assert _shuffles(plan) == 1
    read = re.search(r"ReadSchema: struct<([^>\n]*)", plan)
    assert read and "event_id" in read.group(1) and "user_id" in read.group(1)


def test_projection_prunes_columns(spark):
    plan = _plan(spark, "machine_filter")
    read = re.search(r"ReadSchema: struct<([^>\n]*)", plan).group(1)
    assert "o_orderdate" not in read                     # unused by the production view


@pytest.mark.parametrize("name", ["scoring_context", "value_type_profile", "column_stats"])
def test_top_k_windows_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in _plan(spark, name)


@pytest.mark.parametrize("name", ["join_left", "join_report", "validation_report", "confusion_matrix",
                                  "dataset_summary", "split_report", "stratified_folds"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_label_codes_are_broadcast(spark):
    plan = _plan(spark, "lag_features")
    assert plan.count("BroadcastHashJoin") >= 3 and _shuffles(plan) == 2


def _scans(plan):
    """Table scans of the plan that runs (each table is one file)."""
    return len(re.findall(r"FileScan parquet", plan))


@pytest.mark.parametrize("name, most", [("validate_production", 3), ("validation_report", 4), ("join_left", 3)])
def test_few_scans(spark, name, most):
    assert _scans(_plan(spark, name)) <= most
