"""Landed fixture files through all layers; expected rows are FIXTURES.md §3."""

import datetime as dt
import json

from pyspark.sql import functions as F

from helpers import rows
from tenantlens.plans.build import (
    ACTOR_DAYS,
    SAME_AS_TYPED,
    add_activity,
    build_all,
    build_raw,
    build_star,
    build_typed,
    star_table,
)
from tenantlens.schemas import PAGE_ITEMS_KEY, PARENT_KEYS, RAW_DDL
from tenantlens.sources.landing import (
    CORRUPT,
    RECORD,
    read_records,
    record_fields,
    unnamed_fields,
    usable_records,
)
from tenantlens.sources.tables import TableStore


def test_all_tables_are_written_and_counted(store):
    assert len(store.audit) + len(SAME_AS_TYPED) == 36
    assert store.audit["bronze.items"] == {"rows": 3}
    assert store.audit["silver.calendar"] == {"rows": 366 * 24}


def test_dim_inventory(store):
    table = store.read("gold.dim_inventory")
    assert rows(table, "item_id", "workspace_name", "capacity_name", "item_last_updated") == [
        ("i1", "sales", "main", dt.datetime(2026, 8, 1, 10)),
        ("i2", "sales", "main", None),
        ("i3", None, None, None),
    ]


def test_dim_workspace_keeps_workspaces_without_capacity(store):
    table = store.read("gold.dim_workspace")
    assert rows(table, "workspace_id", "capacity_id", "capacity_name") == [
        ("w1", "c1", "main"),
        ("w2", None, None),
        ("w3", "c9", None),
    ]


def test_merged_identities(store):
    table = store.read("silver.users")
    assert rows(table, "principal_id", "display_name", "principal_type", "email") == [
        ("g1", "Readers", "Group", None),
        ("s1", "loader", "App", None),
        ("u1", "Ana", "User", "Ana@x.org"),
        ("u2", "Ben", "User", "ben@x.org"),
        ("u3", "Cai", "User", "cai@x.org"),
    ]


def test_dim_user_adds_one_service_actor_per_id_without_case(store):
    actors = store.read("gold.dim_user").where("principal_type = 'Service'")
    assert rows(actors, "principal_id", "display_name", "email") == [
        ("Platform", "Platform", None)
    ]


def test_fact_activity_has_one_row_per_event(store):
    table = store.read("gold.fact_activity")
    assert rows(table, "activity_id", "principal_id", "user_id_raw") == [
        ("a1", "u1", "ANA@x.org"),
        ("a2", "s1", "S1"),
        ("a3", "Platform", "Platform"),
        ("a4", "Platform", "platform"),
        ("a5", None, None),
    ]


def test_every_foreign_key_is_null_or_in_its_dimension(store):
    facts, users = store.read("gold.fact_activity"), store.read("gold.dim_user")
    lost = facts.where("principal_id is not null").join(users, "principal_id", "left_anti")
    assert lost.count() == 0
    assert facts.count() == store.read("silver.activity").count()


def test_item_access_has_one_row_per_permission(store):
    table = star_table(store, "fact_item_access")
    assert rows(table, "item_id", "principal_id", "permission") == [
        ("i1", "s1", "Read"),
        ("i1", "s1", "Write"),
        ("i2", "g1", "Read"),
    ]


def test_lineage(store):
    edges = store.read("silver.lineage")
    assert rows(edges, "source_id", "target_id", "relationship_type", "source_type") == [
        ("i1", "i2", "DependsOnDataset", "Report"),
        ("i2", "d1", "DatasourceUsage", "Dataset"),
        ("i2", "d2", "DatasourceUsage", "Dataset"),
    ]
    table = store.read("gold.fact_lineage")
    assert rows(table, "target_id", "target_name") == [
        ("d1", "Fuente Externa"),
        ("d2", "Fuente Externa"),
        ("i2", "Sales model"),
    ]
    assert "workspace_id" not in table.columns


def test_calendar_attributes(store):
    day = star_table(store, "dim_date").where("date = date'2026-08-02' and hour = 5")
    assert rows(day, "day_of_week", "is_weekend") == [("Sunday", True)]


def test_second_run_adds_nothing_to_the_histories(spark, landing, store):
    again = build_raw(spark, str(landing), store, dt.date(2026, 8, 3))
    # a3 to a5 and all others are there already; no fixture event lacks an Id
    read = {"landed_bad_rows": 0, "landed_lost_rows": 0}
    assert again["bronze.activity"] == {"rows": 0, "landed_rows": 5, **read}
    assert again["bronze.capacity_metrics"] == {"rows": 0, "landed_rows": 3, **read}
    assert store.read("bronze.activity").count() == 5


def test_event_without_time_is_found_again(spark, store, tmp_path):
    (tmp_path / "a.json").write_text('{"Id": "x1", "CreationTime": "no time"}\n')
    events = usable_records(read_records(spark, str(tmp_path), RAW_DDL["activity"]))
    other = type(store)(spark, str(tmp_path / "tables"))
    assert add_activity(other, events) == 1
    assert add_activity(other, events) == 0


def test_views_for_sql(spark, store):
    store.create_views(["gold.dim_user"])
    assert spark.sql("SELECT count(*) FROM gold_dim_user").first()[0] == 6


def test_paged_files_give_the_same_tables(spark, landing, store, tmp_path):
    """The fixture records once more, wrapped in pages, one of them broken."""
    pages = tmp_path / "pages"
    for entity in (*PAGE_ITEMS_KEY, "capacity_metrics", "datasource_instances"):
        lines = (landing / entity / "part-0.json").read_text().splitlines()
        (pages / entity).mkdir(parents=True)
        if entity in PAGE_ITEMS_KEY:
            records = [json.loads(line) for line in lines]
            lines = ["{broken"]
            for record in records:
                keys = {k: record.pop(k) for k in PARENT_KEYS.get(entity, ())}
                lines.append(json.dumps({**keys, PAGE_ITEMS_KEY[entity]: [record]}))
        (pages / entity / "0.json").write_text("\n".join(lines) + "\n")
    other = TableStore(spark, str(tmp_path / "tables"))
    audit = build_raw(spark, str(pages), other, dt.date(2026, 8, 3), paged=PAGE_ITEMS_KEY)
    assert audit["bronze.items"] == {
        "rows": 3, "landed_rows": 4, "landed_bad_rows": 1, "landed_lost_rows": 1,
        "landed_broken_lists": 0,
    }
    assert rows(other.read("quarantine.items")) == [("{broken",)]
    for entity in PAGE_ITEMS_KEY:
        columns = [c for c in store.read(f"bronze.{entity}").columns if c not in (CORRUPT, RECORD)]
        if entity not in PARENT_KEYS:  # a child is kept as delivered, without its parent's keys
            columns.append(F.to_json(RECORD))
        expected = rows(store.read(f"bronze.{entity}"), *columns)
        assert rows(other.read(f"bronze.{entity}"), *columns) == expected


# written by hand after the published envelopes, not from the constants of the library
PAGES = {
    "capacities": '{"value": [{"id": "c1"}, {"id": "c2"}]}',
    "workspaces": '{"workspaces": [{"id": "w1"}, {"id": "w2"}]}',
    "items": '{"itemEntities": [{"id": "i1"}, {"id": "i2"}]}',
    "activity": '{"activityEventEntities": [{"Id": "a1"}, {"Id": "a2"}]}',
    "directory_users": '{"value": [{"id": "u1"}, {"id": "u2"}]}',
    "workspace_access": '{"workspaceId": "w1", "value": [{"graphId": "u1"}, {"graphId": "u2"}]}',
    "item_access": '{"itemId": "i1", "workspaceId": "w1", "accessDetails": [{"principal": {"id": "u1"}}, {}]}',
    "tenant_settings": '{"value": [{"settingName": "S1"}, {"settingName": "S2"}]}',
    "workspace_scan": '{"workspaces": [{"id": "w1"}, {"id": "w2"}]}',
}


def test_page_envelopes_missing_arrays_and_lists_that_break_off(spark, landing, tmp_path):
    """Per entity one whole page, one without its array, one that asks for a page that never came."""
    pages = tmp_path / "pages"
    for entity in (*PAGES, "capacity_metrics", "datasource_instances"):
        (pages / entity).mkdir(parents=True)
        if entity in PAGES:
            (pages / entity / "0.json").write_text(PAGES[entity] + '\n{"other": []}\n')
            more = json.dumps(json.loads(PAGES[entity]) | {"continuationToken": "next"})
            (pages / entity / "1.json").write_text(more + "\n")
        else:
            text = (landing / entity / "part-0.json").read_text()
            (pages / entity / "0.json").write_text(text)
    store = TableStore(spark, str(tmp_path / "tables"))
    audit = build_raw(spark, str(pages), store, dt.date(2026, 8, 3), paged=PAGES)
    for entity in PAGES:
        counts = audit[f"bronze.{entity}"]
        assert counts["rows"] == (2 if entity == "activity" else 4), entity
        assert (counts["landed_rows"], counts["landed_lost_rows"], counts["landed_broken_lists"]) == (3, 1, 1)
    assert rows(store.read("bronze.tenant_settings"), "settingName") == [("S1",), ("S1",), ("S2",), ("S2",)]


# a page and the next one of it, written by hand after the two envelopes that name the next page otherwise
TWO_SHAPES = {
    "activity": (
        '{"activityEventEntities": [{"Id": "%d"}], "continuationUri": "https://admin/activity?token=%d"%s}',
        "https://admin/activity?token=%d",
    ),
    "directory_users": (
        '{"@odata.context": "https://graph/users", "value": [{"id": "%d"}], "@odata.nextLink": "https://graph/users?skip=%d"%s}',
        "https://graph/users?skip=%d",
    ),
}


def test_chains_over_files_in_both_shapes(spark, landing, tmp_path):
    """Three files whole; then one without its second file: a list with a hole is counted once."""
    for whole in (True, False):
        folder = tmp_path / f"whole {whole}"
        for entity in (*PAGES, "capacity_metrics", "datasource_instances"):
            (folder / entity).mkdir(parents=True)
            if entity not in TWO_SHAPES:
                text = PAGES.get(entity) or (landing / entity / "part-0.json").read_text()
                (folder / entity / "0.json").write_text(text)
                continue
            page, link = TWO_SHAPES[entity]
            for n in range(3):
                if whole or n != 1:
                    requested = f', "_requested": "{link % n}"' if n else ""
                    line = json.loads(page % (n, n + 1, requested))
                    if n == 2:
                        line = {k: v for k, v in line.items() if "continuation" not in k and "next" not in k}
                    (folder / entity / f"{n}.json").write_text(json.dumps(line) + "\n")
        store = TableStore(spark, str(folder / "tables"))
        audit = build_raw(spark, str(folder), store, dt.date(2026, 8, 3), paged=PAGES)
        for entity in TWO_SHAPES:
            assert audit[f"bronze.{entity}"]["landed_broken_lists"] == (0 if whole else 1)
            assert audit[f"bronze.{entity}"]["rows"] == (3 if whole else 2)


def test_a_field_added_upstream_is_there_to_be_typed_later(spark, landing, tmp_path):
    import shutil

    shutil.copytree(landing, tmp_path / "landing")
    with open(tmp_path / "landing" / "workspaces" / "more.json", "w") as file:
        file.write('{"id": "w9", "name": "new", "domain": {"id": "d1", "tags": ["a", "b"]}, "size": 7}\n')
    store = TableStore(spark, str(tmp_path / "tables"))
    build_raw(spark, str(tmp_path / "landing"), store, dt.date(2026, 8, 3))
    table = store.read("bronze.workspaces")
    later = {"domain_id": ("$.domain.id", "string"), "tag": ("$.domain.tags[1]", "string"), "size": ("$.size", "int")}
    typed = record_fields(table, {**later, "odd": ("$.name", "int")})
    assert rows(typed.where("domain_id IS NOT NULL"), "id", "domain_id", "tag", "size", "odd") == [("w9", "d1", "b", 7, None)]
    found = rows(unnamed_fields(table, RAW_DDL["workspaces"]))
    assert [(f, n) for f, _, n in found] == [("domain", 1), ("size", 1)]
    plan = table.select("id", "name")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:string,name:string>" in plan


def test_actors_by_day_stand_in_for_the_events(spark, landing, tmp_path):
    """A run with ``since`` reads events of its days alone; earlier ones by their actors."""
    tables = TableStore(spark, str(tmp_path / "tables"))
    today = dt.date(2026, 8, 3)
    build_all(spark, str(landing), tables, today)
    seen = rows(tables.index.read(ACTOR_DAYS), "key", "event_date", "spelling")
    assert ("platform", today, "Platform") in seen and len({(k, d) for k, d, _ in seen}) == len(seen)
    build_typed(tables, since=today)
    assert rows(tables.index.read(ACTOR_DAYS), "key", "event_date", "spelling") == seen
    read = tables.read
    asked = []
    tables.read = lambda name: asked.append(name) or read(name)
    build_star(tables, since=today)
    assert asked.count("silver.activity") == 1
    whole = rows(read("gold.dim_user"))
    build_star(tables)
    assert rows(read("gold.dim_user")) == whole


def test_same_id_on_another_day_is_one_event(spark, tmp_path):
    tables = TableStore(spark, str(tmp_path / "tables"))
    for n, time in enumerate(("bad", "2026-08-02T00:00:00", "2026-08-05T00:00:00")):
        folder = tmp_path / str(n)
        folder.mkdir()
        (folder / "a.json").write_text(json.dumps({"Id": "a1", "CreationTime": time}) + "\n")
        add_activity(tables, usable_records(read_records(spark, str(folder), RAW_DDL["activity"])))
    assert rows(tables.read("bronze.activity"), "Id", "CreationTime") == [("a1", "bad")]


def test_since_follows_a_changed_directory(spark, landing, tmp_path):
    """An actor that the directory names later changes in earlier days too."""
    import shutil

    shutil.copytree(landing, tmp_path / "landing")
    tables = TableStore(spark, str(tmp_path / "tables"))
    today = dt.date(2026, 8, 3)
    audit = build_all(spark, str(tmp_path / "landing"), tables, today)
    kinds = {r["kind"] for r in tables.read("bronze.skipped").collect()}
    assert "activity" in kinds and audit["bronze.skipped"]["rows"] > 0
    events = tables.read("gold.fact_activity")
    users = tables.read("gold.dim_user").where("principal_type = 'Service'")
    actor = events.join(users, "principal_id").select(F.lower("user_id_raw")).first()[0]
    with open(tmp_path / "landing" / "directory_users" / "more.json", "w") as file:
        file.write(json.dumps({"id": "x9", "displayName": "X", "mail": actor}) + "\n")
    build_all(spark, str(tmp_path / "landing"), tables, today, since=today)
    partial = rows(star_table(tables, "fact_activity"))
    known = {r[0] for r in tables.read("gold.dim_user").select("principal_id").collect()}
    used = {r[0] for r in star_table(tables, "fact_activity").select("principal_id").collect()}
    assert used - {None} <= known and "x9" in used
    build_star(tables)
    assert rows(star_table(tables, "fact_activity")) == partial


def test_activity_of_later_days_only(spark, landing, tmp_path):
    """A run with ``since`` gives the same tables as a rebuild of all days."""
    tables = TableStore(spark, str(tmp_path / "tables"))
    build_raw(spark, str(landing), tables, dt.date(2026, 8, 3))
    build_typed(tables)
    build_star(tables)
    more = tmp_path / "more.json"
    more.write_text(
        '{"Id": "a6", "CreationTime": "2026-08-03T05:00:00", "UserId": "cai@x.org"}\n'
        '{"Id": "a7", "CreationTime": "unknown", "UserId": "robot"}\n'
    )
    add_activity(tables, usable_records(read_records(spark, str(more), RAW_DDL["activity"])))
    since = dt.date(2026, 8, 3)
    build_typed(tables, since)
    assert tables.audit["silver.activity"] == {"rows": 5}  # a3 to a7
    build_star(tables, since)
    partial = rows(star_table(tables, "fact_activity"))
    assert len(partial) == 7
    build_typed(tables)
    build_star(tables)
    assert rows(star_table(tables, "fact_activity")) == partial
    assert "event_date" not in star_table(tables, "fact_activity").columns


def test_since_keeps_what_its_landed_files_made(spark, landing, tmp_path):
    """A second day writes again only what comes from other files than the first, and all
    tables are those of a run that makes everything again."""
    import shutil

    shutil.copytree(landing, tmp_path / "landing")
    folder, today = str(tmp_path / "landing"), dt.date(2026, 8, 3)
    tables = TableStore(spark, str(tmp_path / "tables"))
    first = build_all(spark, folder, tables, today)
    kept = ("bronze.item_access", "silver.item_access", "bronze.items", "silver.items", "silver.lineage")
    changed = ("bronze.directory_users", "silver.workspaces", "silver.users")
    files = {n: sorted(tables.read(n).inputFiles()) for n in (*kept, *changed)}
    for entity, line in (("directory_users", {"id": "x9", "displayName": "X"}), ("workspaces", {"id": "w8"})):
        with open(tmp_path / "landing" / entity / "more.json", "w") as file:
            file.write(json.dumps(line) + "\n")
    second = build_all(spark, folder, tables, today, since=today)
    for name in kept:
        assert sorted(tables.read(name).inputFiles()) == files[name], name
        assert second[name] == first[name]
    for name in changed:
        assert not set(tables.read(name).inputFiles()) & set(files[name]), name
    assert {r[0] for r in tables.read("silver.users").select("principal_id").collect()} >= {"x9", "s1", "u1"}
    names = [n for n in second if n.startswith(("silver.", "gold.")) and n != "gold.next_actor_keys"]
    partial = {n: rows(tables.read(n)) for n in names}
    tables.overwrite("bronze.items", tables.read("bronze.items").limit(1).localCheckpoint())
    third = build_all(spark, folder, tables, today, since=today)  # a table that was written otherwise is not trusted
    assert third["bronze.items"]["rows"] == 3
    build_all(spark, folder, tables, today)
    assert not set(tables.read("bronze.item_access").inputFiles()) & set(files["bronze.item_access"])
    assert {n: rows(tables.read(n)) for n in names} == partial


def test_whole_records_are_packed(spark, tmp_path):
    """Raw tables hold each record twice, typed and whole: on disk that is less than its text."""
    text = spark.range(5000).select(
        F.format_string('{"id": "i%d", "displayName": "item %d", "workspaceId": "w%d"}', "id", "id", F.col("id") % 7).alias("value")
    )
    text.coalesce(1).write.text(str(tmp_path / "landing"))
    tables = TableStore(spark, str(tmp_path / "tables"))
    records = usable_records(read_records(spark, str(tmp_path / "landing"), RAW_DDL["items"]))
    day = records.withColumn("day", F.lit(1))
    tables.overwrite("bronze.items", records)
    tables.append("bronze.days", day, ["day"])
    tables.replace_partitions("bronze.days", day, ["day"])
    for name in ("bronze.items", "bronze.days"):
        assert tables.read(name).count() == 5000
        assert all(f.endswith(".zstd.parquet") for f in tables.read(name).inputFiles()), name
        assert tables.bytes(name) < 5000 * 60 / 3
