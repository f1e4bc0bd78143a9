"""Measures and filter contexts on the fixture model; values are FIXTURES.md §3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tenantlens.functions.predicates import Contains, HalfOpen, Known, OneOf
from tenantlens.plans import reports
from tenantlens.plans.measures import MEASURES, Measure, evaluate
from tenantlens.plans.star import RELATIONSHIPS, base_table, path_between

ACTIVITY = ("total_activities", "total_failed_activities", "pct_failed_activities")


def one(df):
    return tuple(df.first())


def cards(model, page, filters=None):
    return {r["measure"]: r["value"] for r in reports.report_card(model, page, filters).collect()}


def test_there_are_thirteen_measures_and_eight_relationships():
    assert len(MEASURES) == 13
    assert len(RELATIONSHIPS) == 8


def test_blank_success_counts_as_failed(model):
    assert cards(model, "activity") == {
        "total_activities": 5.0,
        "total_failed_activities": 2.0,
        "pct_failed_activities": 0.4,
    }


def test_own_filter_replaces_the_outer_one(model):
    chosen = {"fact_activity.is_success": OneOf((True,))}
    assert one(evaluate(model, ACTIVITY, chosen)) == (3, 2, pytest.approx(2 / 3))


def test_other_outer_filters_stay(model):
    chosen = {
        "fact_activity.is_success": OneOf((True,)),
        "fact_activity.workload": OneOf(("Lake",)),
    }
    assert one(evaluate(model, ACTIVITY, chosen)) == (0, 1, None)


def test_counts_of_nothing_are_zero_and_their_ratio_is_blank(model):
    nothing = {"fact_activity.workload": OneOf(("none",))}
    assert one(evaluate(model, ACTIVITY, nothing)) == (0, 0, None)
    nobody = {"dim_user.principal_type": OneOf(("none",))}
    assert one(evaluate(model, ACTIVITY, nobody)) == (0, 0, None)


def test_filter_on_a_related_dimension(model):
    services = {"dim_user.principal_type": OneOf(("Service",))}
    assert one(evaluate(model, ACTIVITY, services)) == (2, 1, 0.5)
    known = {"dim_user.principal_type": Known()}
    assert one(evaluate(model, ACTIVITY, known))[0] == 4
    unknown = {"dim_user.principal_type": OneOf((None,))}
    assert one(evaluate(model, ACTIVITY, unknown))[0] == 1


def test_filter_without_a_path_has_no_effect(model):
    elsewhere = {
        "dim_date.date": OneOf((dt.date(1999, 1, 1),)),
        "fact_lineage.relationship_type": OneOf(("none",)),
    }
    assert one(evaluate(model, ACTIVITY, elsewhere))[0] == 5


def test_groups_on_facts_and_dimensions(model):
    result = evaluate(model, ACTIVITY[:2], None, ["dim_user.principal_type", "fact_activity.workload"])
    assert rows(result) == [
        (None, "Platform", 1, 0),
        ("App", "Lake", 1, 1),
        ("Service", "Platform", 2, 1),
        ("User", "Platform", 1, 0),
    ]


def test_groups_on_the_column_a_measure_filters_itself(model):
    by_success = evaluate(model, ACTIVITY, None, ["fact_activity.is_success"])
    assert rows(by_success) == [
        (None, 1, 2, 2.0),
        (False, 1, 2, 2.0),
        (True, 3, 2, pytest.approx(2 / 3)),
    ]
    both = evaluate(
        model, ACTIVITY[:2], None, ["fact_activity.workload", "fact_activity.is_success"]
    )
    assert rows(both) == [
        ("Lake", False, 1, 1),
        ("Platform", None, 1, 1),
        ("Platform", True, 3, 1),
    ]


def test_filter_through_two_relationships(model):
    permissions = {"permissions": Measure("fact_item_access", "rows")}
    sales = {"dim_workspace.workspace_name": OneOf(("sales",))}
    assert one(evaluate(model, ["permissions"], sales, measures=permissions)) == (3,)


def test_totals(model):
    assert cards(model, "inventory") == {
        "total_capacities": 3.0,
        "total_workspaces": 3.0,
        "total_items": 3.0,
    }
    only_c1 = {"dim_workspace.capacity_id": OneOf(("c1",))}
    assert one(evaluate(model, ["total_capacities", "total_workspaces"], only_c1)) == (1, 1)


def test_dimension_filter_reaches_items(model):
    sales = {"dim_workspace.workspace_name": OneOf(("sales",))}
    assert one(evaluate(model, ["total_items"], sales)) == (2,)


def test_users(model):
    assert cards(model, "security") == {
        "total_users": 3.0,
        "total_service_principals": 1.0,
        "total_app_principals": 1.0,
        "total_security_groups": 1.0,
    }
    groups = {"dim_user.principal_type": OneOf(("Group",))}
    assert cards(model, "security", groups)["total_users"] == 3.0


def test_capacity(model):
    assert cards(model, "capacity") == {
        "hours_over_100_pct_cu": 1.0,
        "background_cu_pct": 160.5,
        "interactive_cu_pct": pytest.approx(0.5),
    }


def test_measures_of_two_tables_do_not_mix(model):
    with pytest.raises(ValueError, match="several tables"):
        evaluate(model, ["total_items", "total_users"])


def test_spine_shows_hours_without_use(model):
    hours = {
        "dim_date.start_of_hour": HalfOpen(
            dt.datetime(2026, 8, 2, 9), dt.datetime(2026, 8, 2, 12)
        )
    }
    result = reports.capacity_by_hour(model, hours)
    assert [tuple(r) for r in result.collect()] == [
        (dt.date(2026, 8, 2), dt.datetime(2026, 8, 2, 11), 40.0, 0.3),
        (dt.date(2026, 8, 2), dt.datetime(2026, 8, 2, 10), None, None),
        (dt.date(2026, 8, 2), dt.datetime(2026, 8, 2, 9), 120.5, 0.2),
    ]


def test_paths_go_from_facts_to_dimensions_only():
    assert path_between("fact_item_access", "dim_workspace") == [
        "fact_item_access", "dim_inventory", "dim_workspace",
    ]
    assert path_between("dim_user", "fact_activity") is None
    assert path_between("fact_activity", "dim_date") is None
    assert base_table(["dim_workspace", "dim_user"]) == "fact_item_access"
    assert base_table(["dim_workspace", "fact_workspace_access", "dim_user"]) == "fact_workspace_access"


def test_search_is_without_case(model):
    result = reports.slicer_values(
        model, ["dim_inventory.item_name"], Contains("sALES").on(F.col("value"))
    )
    assert rows(result) == [("dim_inventory.item_name", "Sales model")]


def test_bars_add_up_to_the_card(model, spark):
    """Hours outside the calendar and use without an hour stay under a blank member."""
    facts = model["fact_capacity_metrics"]
    outside = facts.withColumn("start_of_hour", F.lit(None).cast(facts.schema["start_of_hour"].dataType))
    more = model.with_table("fact_capacity_metrics", facts.unionByName(outside))
    bars = reports.capacity_by_hour(more).agg(F.sum("background_cu_pct")).first()[0]
    assert bars == cards(more, "capacity")["background_cu_pct"] == 2 * 160.5


def test_groups_by_base_column_and_hot_key(model):
    by = ["fact_activity.activity_id", "dim_user.principal_type"]
    assert evaluate(model, ["total_activities"], None, by).count() == 5
