"""Landed files: records, pages, children, bad lines."""

import datetime as dt
import json

from pyspark.sql import functions as F

from helpers import rows
from tenantlens.schemas import RAW_DDL
from tenantlens.sources.calendar import calendar_hours, calendar_table
from tenantlens.sources.landing import (
    CORRUPT,
    attach_parent_keys,
    flatten_pages,
    import_tabular,
    landing_audit,
    parents_without_children,
    parse_records,
    read_pages,
    read_records,
    usable_records,
)
from tenantlens.sources.tables import TableStore, preview


def land(folder, *objects):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [o if isinstance(o, str) else json.dumps(o) for o in objects]
    (folder / f"page-{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_missing_fields_are_null_and_extra_ones_ignored(spark, tmp_path):
    path = land(tmp_path / "w", {"id": "1", "later": {"x": 1}}, {"id": "2", "name": "n"})
    records = read_records(spark, path, RAW_DDL["workspaces"])
    assert rows(usable_records(records), "id", "name", "capacityId") == [
        ("1", None, None),
        ("2", "n", None),
    ]


def test_empty_folder_keeps_its_columns(spark, tmp_path):
    (tmp_path / "none").mkdir()
    records = read_records(spark, str(tmp_path / "none"), RAW_DDL["item_access"])
    assert records.count() == 0
    assert records.select("principal.userDetails.userPrincipalName").columns == ["userPrincipalName"]


def test_bad_lines_are_counted_and_good_fields_kept(spark, tmp_path):
    path = land(tmp_path / "a", {"Id": "1"}, '{"Id": "2", "UserType": "seven"}', "no json at all")
    records = read_records(spark, path, RAW_DDL["activity"])
    assert rows(usable_records(records), "Id", "UserType") == [("1", None), ("2", None)]
    counts = records.cache().agg(*[c.alias(n) for n, c in landing_audit(records).items()])
    assert counts.first().asDict() == {"rows": 3, "bad_rows": 2, "lost_rows": 1}


def test_pages_are_flattened_and_pages_without_the_array_give_nothing(spark, tmp_path):
    folder = tmp_path / "pages"
    land(folder, {"workspaces": [{"id": "1"}, {"id": "2"}], "continuationToken": "t"})
    land(folder, {"workspaces": [{"id": "3"}]})
    path = land(folder, {"other": 1}, {"workspaces": []})
    pages = read_pages(spark, path, "workspaces", RAW_DDL["workspaces"])
    assert rows(flatten_pages(pages, "workspaces"), "id") == [("1",), ("2",), ("3",)]


def test_children_get_their_parents_keys(spark, tmp_path):
    access = {"itemAccessDetails": {"type": "Report", "permissions": ["Read"]}}
    path = land(
        tmp_path / "access",
        {"itemId": "i1", "workspaceId": "w1", "accessDetails": [access, access]},
        {"itemId": "i2", "workspaceId": "w1", "accessDetails": []},
    )
    parents = ["itemId", "workspaceId"]
    pages = read_pages(spark, path, "accessDetails", RAW_DDL["item_access"], parents)
    children = attach_parent_keys(pages, "accessDetails", {k: k for k in parents})
    assert sorted(children.columns) == sorted(["itemId", "workspaceId", "principal", "itemAccessDetails"])
    assert rows(children, "itemId", "workspaceId") == [("i1", "w1")] * 2
    items = spark.createDataFrame([("i1",), ("i2",), ("i3",)], "itemId STRING")
    assert rows(parents_without_children(items, children, "itemId")) == [("i2",), ("i3",)]


def test_workspaces_without_access(store):
    parents = store.read("bronze.workspaces").select(F.col("id").alias("workspaceId"))
    left = parents_without_children(parents, store.read("bronze.workspace_access"), "workspaceId")
    assert rows(left) == [("w2",)]


def test_records_in_a_text_column(spark):
    texts = spark.createDataFrame([(1, '{"id": "a"}'), (2, "[]x"), (3, None)], "n INT, t STRING")
    parsed = parse_records(texts, "t", "id STRING, size INT", keep=["n"])
    assert rows(parsed, "n", "id", "size") == [(1, "a", None), (2, None, None), (3, None, None)]
    assert rows(parsed.where(F.col(CORRUPT).isNotNull()), "n") == [(2,)]
    usable = usable_records(parsed, keep=["n"])
    assert rows(usable, "n") == [(1,), (3,)]
    assert usable._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_tabular_import(spark):
    delivered = spark.createDataFrame(
        [("2026-08-02", "2026-08-02 09:00:00", 1.5)], ["Dates[Day]", "Start of hour", "[Pct]"]
    )
    names = {"Dates[Day]": "date", "Start of hour": "start_of_hour", "[Pct]": "background_pct"}
    types = {"date": "date", "start_of_hour": "timestamp"}
    result = import_tabular(delivered, names, types, {"capacity_id": "c1"})
    assert rows(result) == [(dt.date(2026, 8, 2), dt.datetime(2026, 8, 2, 9), 1.5, "c1")]


def test_calendar_covers_a_year_up_to_the_last_hour_of_the_day(spark):
    table = calendar_table(calendar_hours(spark, dt.date(2026, 8, 3)))
    assert table.count() == 8784
    ends = table.agg(F.min("start_of_hour"), F.max("start_of_hour")).first()
    assert tuple(ends) == (dt.datetime(2025, 8, 3), dt.datetime(2026, 8, 3, 23))
    days = table.where("hour = 0 and date >= '2026-08-01'")
    assert rows(days, "date", "day_of_week", "is_weekend") == [
        (dt.date(2026, 8, 1), "Saturday", True),
        (dt.date(2026, 8, 2), "Sunday", True),
        (dt.date(2026, 8, 3), "Monday", False),
    ]


def test_full_refresh_replaces_rows_and_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.overwrite("t", spark.range(5)) == {"rows": 5}
    assert store.overwrite("t", spark.range(3).selectExpr("id AS a", "id AS b")) == {"rows": 3}
    assert store.read("t").columns == ["a", "b"]
    assert store.overwrite("t", spark.range(0)) == {"rows": 0}
    assert store.read("t").columns == ["id"]


def test_ordered_preview_keeps_the_first_rows_of_each_task(spark):
    first = preview(spark.range(10_000), F.desc("id"), limit=3)
    assert [r["id"] for r in first.collect()] == [9999, 9998, 9997]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().toString()
