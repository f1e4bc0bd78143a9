"""Physical plans: what is read, what is pushed down, what is not shuffled."""

import re

import pytest

from __spark_entry__ import queries
from test_queries import FOLDER, NAMES, pytestmark  # noqa: F401
from tenantlens.functions.predicates import HalfOpen, OneOf
from tenantlens.plans import reports
from tenantlens.plans.measures import evaluate
from workload.standins import Governance


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("row_audit", "activity_stream")])
def test_no_python_workers_and_no_pairing_of_all_rows(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for bad in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin", "WindowExec"):
        assert bad not in text


def test_measures_read_their_columns_only(model):
    text = plan(evaluate(model, ["total_activities", "total_failed_activities"]))
    assert read_columns(text) == [{"is_success"}]


def test_filters_reach_the_scan_through_joins(model):
    filters = {
        "fact_activity.workload": OneOf(("Lake",)),
        "fact_activity.creation_time": HalfOpen("2026-08-01", "2026-08-04"),
    }
    text = plan(reports.table(model, "activity", filters))
    pushed = next(p for p in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text) if "workload" in p)
    # EqualTo or In, and both ends of the range
    assert "creation_time" in pushed and "GreaterThanOrEqual" in pushed and "LessThan" in pushed


def test_facts_are_merged_before_dimensions_are_joined(model):
    text = plan(evaluate(model, ["total_activities"], None, ["dim_user.principal_type"]))
    join = text.index("Join")
    assert "partial_count(1)" in text[join:]
    assert "partial_sum" in text[:join]


def test_matrix_levels_are_expanded_over_leaf_groups(model):
    text = plan(reports.activity_matrix(model))
    assert "partial_count(1)" in text[text.index("Expand") :]


def test_report_on_small_dimensions_shuffles_once(model):
    text = plan(reports.table(model, "item_access"))
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["capacity_matrix", "flag_range_percent"])
def test_extremes_come_from_the_groups_that_are_there(spark, name):
    """One scan of the facts, whose shuffled groups are read twice."""
    df = queries()[name](spark, FOLDER)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("Scan parquet") - final.count("ReusedExchange") <= 1 or "ReusedExchange" in final


@pytest.mark.parametrize("name", ["known_keys", "edges_union"])
def test_sources_are_read_once(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    assert text.split("Initial Plan")[-1].count("Scan parquet") == 1


def test_sorted_report_shuffles_facts_once(model):
    text = plan(reports.table(model, "activity"))
    assert text.count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning" not in text


def test_actor_keys_are_made_once(spark):
    """The events look their actors up in a written table: no aggregate is repeated in the plan."""
    made = Governance(spark, "/root/testdata/sf0.001").make("fact_activity")
    assert "Aggregate" not in made._jdf.queryExecution().optimizedPlan().toString()
