"""Typed columns, predicates, identity rules, matrices and flags."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tenantlens.functions.columns import normalize_code, null_before, parse_timestamp
from tenantlens.functions.predicates import Contains, HalfOpen, Known, OneOf
from tenantlens.operators.aggregates import (
    flag_range_percent,
    flag_threshold,
    hourly_summary,
    subtotals,
)
from tenantlens.operators.identity import (
    actor_keys,
    known_keys,
    merge_identities,
    resolve_actor,
    service_actors,
)
from tenantlens.operators.lineage import lineage_edges, lineage_targets
from tenantlens.plans import reports
from tenantlens.schemas import RAW_DDL

PRINCIPAL = "principal_id STRING, display_name STRING, principal_type STRING, email STRING"


def test_timestamps(spark):
    texts = ["2026-08-01T10:00:00Z", "2026-08-01T10:00:00", "0001-01-01T00:00:00", "soon", None]
    parsed = spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        "t", null_before(parse_timestamp("t")).alias("ts")
    )
    at_ten = dt.datetime(2026, 8, 1, 10)
    assert [r["ts"] for r in parsed.collect()] == [at_ten, at_ten, None, None, None]


def test_codes(spark):
    codes = spark.createDataFrame([("ServicePrincipal",), ("User",), (None,)], "c STRING")
    assert [r[0] for r in codes.select(normalize_code(F.col("c"))).collect()] == ["App", "User", None]


@pytest.mark.parametrize(
    "predicate, kept",
    [
        (OneOf(("a",)), ["a"]),
        (OneOf(("a", None)), ["a", None]),
        (OneOf((None,)), [None]),
        (OneOf(()), []),
        (Known(), ["a", "B", "c"]),
        (HalfOpen("B", "c"), ["a", "B"]),
        (HalfOpen(start="b"), ["c"]),
        (HalfOpen(end="a"), ["B"]),
        (HalfOpen(), ["a", "B", "c", None]),
        (Contains("b"), ["B"]),
    ],
)
def test_predicates(spark, predicate, kept):
    values = spark.createDataFrame([("a",), ("B",), ("c",), (None,)], "v STRING")
    found = [r["v"] for r in values.where(predicate.on(F.col("v"))).collect()]
    assert found == kept


def test_first_known_value_follows_the_order_of_the_sources(spark):
    def source(*data):
        return spark.createDataFrame(list(data), PRINCIPAL)

    merged = merge_identities(
        [
            source(("p", None, "User", None), ("q", "b", "App", None), ("q", "a", "App", None)),
            source(("p", "second", "Group", None)),
            source(("p", "third", "User", "p@x.org"), ("r", None, "User", None)),
        ]
    )
    assert rows(merged) == [
        ("p", "second", "User", "p@x.org"),
        ("q", "a", "App", None),
        ("r", None, "User", None),
    ]


def principals(spark):
    data = [
        ("U1", "one", "User", "Shared@x.org"),
        ("u2", "two", "User", "shared@X.org"),
        ("u3", "three", "User", "u1"),
        ("u4", "four", "User", None),
    ]
    return spark.createDataFrame(data, PRINCIPAL)


def activity(spark, *users):
    data = [(f"a{i}", u) for i, u in enumerate(users)]
    return spark.createDataFrame(data, "activity_id STRING, user_id STRING")


def test_shared_keys_stand_for_one_principal(spark):
    assert rows(actor_keys(principals(spark))) == [
        ("shared@x.org", "U1"),  # of two e-mails the smaller id
        ("u1", "U1"),  # an id before an e-mail
        ("u2", "u2"),
        ("u3", "u3"),
        ("u4", "u4"),
    ]
    assert known_keys(principals(spark)).count() == 5


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "hot_key_rows": 2}])
def test_events_keep_one_row_each(spark, options):
    users = ["u1", "U1", "SHARED@x.org", "u4", "nobody", None, "u4", "u4"]
    resolved = resolve_actor(activity(spark, *users), principals(spark), **options)
    assert rows(resolved, "activity_id", "principal_id") == [
        ("a0", "U1"), ("a1", "U1"), ("a2", "U1"), ("a3", "u4"),
        ("a4", None), ("a5", None), ("a6", "u4"), ("a7", "u4"),
    ]
    assert [r["user_id_raw"] for r in resolved.orderBy("activity_id").collect()] == users


def test_service_actors_are_unknown_named_users(spark):
    users = ["u1", "SHARED@x.org", "Engine", "engine", None, "job"]
    found = service_actors(activity(spark, *users), principals(spark))
    assert rows(found) == [("Engine", "Engine", "Service", None), ("job", "job", "Service", None)]


def test_no_edges_from_missing_lists(spark):
    scan = spark.createDataFrame([], RAW_DDL["workspace_scan"]).unionByName(
        spark.sql("SELECT 'w' AS id, NULL AS datasets, array() AS reports"), allowMissingColumns=False
    )
    assert lineage_edges(scan).count() == 0


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "hot_key_rows": 3}])
def test_many_edges_to_one_outside_source(spark, options):
    edges = spark.range(50).select(
        F.lit("w").alias("workspace_id"), F.lit("Dataset").alias("source_type"),
        F.concat(F.lit("i"), "id").alias("source_id"), F.lit("n").alias("source_name"),
        F.lit("DatasourceUsage").alias("relationship_type"), F.lit("Datasource").alias("target_type"),
        F.when(F.col("id") < 40, "d1").otherwise(F.concat(F.lit("i"), "id")).alias("target_id"),
    )
    items = spark.createDataFrame([("i41", "Sales"), ("i42", None)], "item_id STRING, item_name STRING")
    named = lineage_targets(edges, items, **options)
    counts = {r["target_name"]: r["count"] for r in named.groupBy("target_name").count().collect()}
    assert counts == {"Fuente Externa": 49, "Sales": 1}


def test_subtotals_tell_a_missing_member_from_a_total(spark):
    data = [("a", "x", 1.0), ("a", None, 3.0), (None, "x", None), ("a", "x", 2.0)]
    table = spark.createDataFrame(data, "g STRING, h STRING, v DOUBLE")
    matrix = subtotals(table, ["g", "h"], counts=["n"], averages={"avg_v": "v"})
    assert rows(matrix, "g", "h", "total_g", "total_h", "n", "avg_v") == sorted(
        [
            (None, None, True, True, 4, 2.0),
            ("a", None, False, True, 3, 2.0),
            (None, None, False, True, 1, None),
            ("a", "x", False, False, 2, 1.5),
            ("a", None, False, False, 1, 3.0),
            (None, "x", False, False, 1, None),
        ],
        key=lambda t: [(v is not None, str(v)) for v in t],
    )


def test_leaf_groups_add_up_to_the_grand_total(model):
    matrix = reports.activity_matrix(model)
    total = matrix.where("total_workspace_name").first()["total_activities"]
    leaves = matrix.where("not total_operation").agg(F.sum("total_activities")).first()[0]
    assert total == leaves == 5


def test_range_flag_uses_the_extremes_of_all_groups(spark):
    groups = spark.createDataFrame([(0.0,), (2.9,), (3.0,), (1000.0,), (None,)], "v DOUBLE")
    flagged = flag_range_percent(groups, "v", "flag")
    assert [r["flag"] for r in flagged.collect()] == [False, False, True, True, None]
    plan = flagged._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Window" not in plan


def test_threshold_flag_includes_the_bound(spark):
    groups = spark.createDataFrame([(0.29,), (0.3,), (None,)], "v DOUBLE")
    assert [r["f"] for r in flag_threshold(groups, "v", "f").collect()] == [False, True, None]


def test_capacity_matrix_flags_hours_only(model):
    matrix = reports.capacity_matrix(model)
    assert matrix.where("total_start_of_hour").select("background_flag").distinct().collect()[0][0] is None
    hours = matrix.where("not total_start_of_hour")
    columns = ("avg_background_pct", "background_flag", "interactive_flag")
    assert rows(hours, F.hour("start_of_hour"), *columns) == [
        (11, 20.0, False, False),
        (9, 120.5, True, False),
    ]


def test_hourly_summary_in_a_window(spark):
    times = [(dt.datetime(2026, 8, d, 9, m), float(m)) for d in (1, 2, 3) for m in (5, 50)]
    usage = spark.createDataFrame(times, "ts TIMESTAMP, v DOUBLE")
    bounds = (dt.datetime(2026, 8, 2), dt.datetime(2026, 8, 3))
    result = hourly_summary(usage, "ts", [], {"v": "v"}, bounds, ordered=True)
    assert rows(result) == [(dt.date(2026, 8, 2), dt.datetime(2026, 8, 2, 9), 55.0)]


def test_report_tables_on_the_fixture(model):
    known = {"dim_tenant_setting.delegate_to_capacity": Known()}
    assert rows(reports.table(model, "settings", known), "setting_name") == [("ExportToCsv",)]
    access = reports.table(model, "item_access")
    assert rows(access, "workspace_name", "item_name", "permission", "principal_type") == [
        ("sales", "Daily report", "Read", "ServicePrincipal"),
        ("sales", "Daily report", "Write", "ServicePrincipal"),
        ("sales", "Sales model", "Read", "Group"),
    ]
    since = {"fact_activity.creation_time": HalfOpen(dt.datetime(2026, 8, 3))}
    events = reports.table(model, "activity", since)
    assert [r["activity_id"] for r in events.collect()] == ["a3", "a4", "a5"]
    # both outside sources of one data set show as one row
    assert reports.table(model, "lineage").count() == 2
    assert reports.table(model, "workspace_access").count() == 3
    assert reports.table(model, "principals").count() == 6
    assert reports.table(model, "inventory").count() == 3


def test_there_are_29_slicers_and_each_has_values(model):
    names = [n for page in reports.SLICERS.values() for n in page]
    assert len(names) == 29
    values = reports.slicer_values(model, sorted(set(names)))
    assert values.select("slicer").distinct().count() == len(set(names))
    assert rows(values.where("slicer = 'dim_user.principal_type'"), "value") == [
        ("App",), ("Group",), ("Service",), ("User",),
    ]
