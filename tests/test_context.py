"""Slicers under other filters, distinct counts over relations, digests of the layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tenantlens.functions.predicates import HalfOpen, Known, OneOf
from tenantlens.plans import reports
from tenantlens.plans.audit import activity_by_day
from tenantlens.plans.build import build_all
from tenantlens.plans.measures import MEASURES, Measure, evaluate
from tenantlens.plans.star import split_name
from tenantlens.sources.tables import TableStore

ALL = list(dict.fromkeys(n for page in reports.SLICERS.values() for n in page))
CHOSEN = [
    {"dim_workspace.workspace_name": OneOf(("sales",)), "dim_user.principal_type": OneOf(("User", None))},
    {"dim_inventory.item_type": OneOf(("Report",)), "fact_item_access.permission": OneOf(("Read",))},
    {"dim_user.email": Known(), "fact_activity.workload": OneOf(("Lake",)), "dim_workspace.capacity_name": OneOf((None,))},
    {"fact_activity.creation_time": HalfOpen("2026-08-03", None), "dim_date.is_weekend": OneOf((True,))},
]


@pytest.mark.parametrize("filters", CHOSEN)
def test_a_slicer_offers_what_the_other_filters_leave(model, filters):
    found = {}
    for r in reports.slicer_values(model, ALL, filters=filters).collect():
        found.setdefault(r["slicer"], set()).add(r["value"])
    for name in ALL:
        others = {k: p for k, p in filters.items() if k != name}
        left = model.flat(split_name(name)[0], [name], others)
        column = F.col(f"`{name}`")
        if name in reports.RANGE_SLICERS:
            low, high = left.agg(F.min(column).cast("string"), F.max(column).cast("string")).first()
            assert found[name] == {low, high}, name
        else:
            values = {r[0] for r in left.select(column.cast("string")).distinct().collect()}
            assert found.get(name, set()) == values, name


def test_slicers_of_a_table_take_one_scan_of_it(model):
    names = [n for n in ALL if n.startswith("fact_activity.") and n not in reports.RANGE_SLICERS]
    found = reports.slicer_values(model, names, filters={"fact_activity.workload": OneOf(("Lake",))})
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Scan parquet") == 1


def test_distinct_counts_over_a_relation(model):
    measures = MEASURES | {"actors": Measure("fact_activity", "distinct", "principal_id")}
    names = ["total_activities", "actors"]
    by = ["dim_user.principal_type"]
    assert rows(evaluate(model, names, None, by, measures=measures)) == [
        (None, 1, 1), ("App", 1, 1), ("Service", 2, 1), ("User", 1, 1),
    ]
    services = {"dim_user.principal_type": OneOf(("Service",))}
    assert rows(evaluate(model, names, services, measures=measures)) == [(2, 1)]
    plan = evaluate(model, ["actors"], services, measures=measures)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[principal_id" in plan[plan.index("Join") :]  # before the join


def test_a_changed_row_is_found_by_its_day(spark, landing, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    build_all(spark, str(landing), store, dt.date(2026, 8, 3))
    days = [dt.date(2026, 8, 2), dt.date(2026, 8, 3)]
    assert rows(activity_by_day(store)) == [(days[0], 2, 2, 2, True), (days[1], 3, 3, 3, True)]
    changed = store.read("silver.activity").withColumn(
        "workload", F.when(F.col("activity_id") == "a2", F.lit(None)).otherwise(F.col("workload"))
    )
    store.overwrite("silver.other", changed, ["event_date"])
    store.overwrite("silver.activity", store.read("silver.other"), ["event_date"])
    assert rows(activity_by_day(store)) == [(days[0], 2, 2, 2, False), (days[1], 3, 3, 3, True)]
