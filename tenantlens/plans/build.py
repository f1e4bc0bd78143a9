"""Layer-by-layer build: landed files to raw tables, typed tables, star schema.

Each step reads tables of the layer before and writes its own, so any step can
be run again alone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tenantlens.functions.columns import parse_timestamp
from tenantlens.operators import identity
from tenantlens.operators.history import (
    ACTIVITY_KEYS,
    CAPACITY_KEYS,
    activity_window,
    merge_insert_only,
)
from tenantlens.operators.inventory import item_dimension, workspace_dimension
from tenantlens.operators.key_index import KeyIndex
from tenantlens.operators.lineage import lineage_edges, lineage_targets
from tenantlens.operators.typed import typed_table
from tenantlens.plans.star import StarModel
from tenantlens.schemas import (
    NEXT_PAGE,
    NEXT_PAGE_OF,
    PAGE_ITEMS_KEY,
    PARENT_KEYS,
    RAW_DDL,
    TYPED_COLUMNS,
)
from tenantlens.sources.calendar import calendar_hours, calendar_table
from tenantlens.sources.landing import (
    attach_parent_keys,
    broken_lists,
    count_broken,
    flatten_pages,
    landed_files,
    landing_audit,
    parents_without_children,
    quarantined,
    read_pages,
    read_records,
    usable_records,
)
from tenantlens.sources.tables import TableStore

SNAPSHOTS = (
    "capacities",
    "workspaces",
    "items",
    "directory_users",
    "workspace_access",
    "item_access",
    "tenant_settings",
    "workspace_scan",
)
STAR_TABLES = (
    "dim_inventory",
    "dim_workspace",
    "dim_user",
    "dim_tenant_setting",
    "dim_date",
    "fact_activity",
    "fact_workspace_access",
    "fact_item_access",
    "fact_lineage",
    "fact_capacity_metrics",
)
# Star tables that are a typed table as it stands. They are read where they
# lie; writing them a second time would only double the largest tables.
SAME_AS_TYPED = {
    "dim_tenant_setting": "tenant_settings",
    "dim_date": "calendar",
    "fact_workspace_access": "workspace_access",
    "fact_item_access": "item_access",
    "fact_capacity_metrics": "capacity_metrics",
}
# Sources of the principals, the first one to be asked first.
PRINCIPALS = {
    "workspace_access": identity.principals_of_workspace_access,
    "item_access": identity.principals_of_item_access,
    "directory_users": identity.principals_of_directory,
}
EVENT_DATE = "event_date"
ACTOR_DAYS = "actor_days"
INDEXED_FROM_BYTES = 256 << 20


def landed(lines: DataFrame, entity: str, key: str | None, observation: Observation) -> DataFrame:
    """Records of one entity; bad lines are counted by the observation."""
    counts = landing_audit(lines, key)
    lines = lines.observe(observation, *[c.alias(n) for n, c in counts.items()])
    if key is None:
        return lines
    parents = PARENT_KEYS.get(entity, ())
    return attach_parent_keys(lines, key, {p: p for p in parents}) if parents else flatten_pages(lines, key)


def _lines(spark: SparkSession, landing: str, entity: str, paged: bool) -> tuple[DataFrame, str | None]:
    """Records or pages as landed, and the pages' array. The files are listed here, once."""
    path, ddl = f"{landing}/{entity}", RAW_DDL[entity]
    if not paged:
        return read_records(spark, path, ddl), None
    key = PAGE_ITEMS_KEY[entity]
    token = NEXT_PAGE_OF.get(entity, NEXT_PAGE)
    return read_pages(spark, path, key, ddl, PARENT_KEYS.get(entity, ()), token, whole=True), key


def build_raw(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    today: dt.date,
    paged: Iterable[str] = (),
    keep: bool = False,
) -> dict[str, dict[str, int]]:
    """Raw tables from the files ``<landing>/<entity>``: one record per line,
    or for entities in ``paged`` one page. Returns the rows of each write with
    the count of lines (pages) read, of bad ones, of ones of which nothing is
    kept, and of page lists that break off. The text of bad lines is kept in
    ``quarantine.<entity>``; only if there are any, the same files are read again.
    Records are kept whole, see ``sources.landing``. ``keep``: a snapshot whose landed
    files are those it was made from stays as it is, with its counts."""
    paged = set(paged)
    audit = {}

    def snapshot(entity: str) -> None:
        name = f"bronze.{entity}"
        # listed before they are read: what lands meanwhile is another state
        shape = f"{RAW_DDL[entity]} {entity in paged}"
        files = "\n".join([shape, *sorted(landed_files(spark, f"{landing}/{entity}"))])
        source = hashlib.sha256(files.encode()).hexdigest()
        made = store.made(name) if keep else {}
        if made.get("source") == source:
            audit[name], store.audit[name] = made["counts"], {"rows": made["counts"]["rows"]}
            return
        load(entity, lambda rows: store.overwrite(name, rows)["rows"])
        store.note(name, source, audit[name])

    def load(entity: str, write) -> None:
        counted = Observation(f"land {entity}")
        lines, key = _lines(spark, landing, entity, entity in paged)
        written = write(landed(lines, entity, key, counted))
        read = {f"landed_{n}": int(v or 0) for n, v in counted.get.items()}
        if entity in paged:
            lists = broken_lists(lines, PARENT_KEYS.get(entity, ()))
            read["landed_broken_lists"] = count_broken(lists)
        audit[f"bronze.{entity}"] = {"rows": written, **read}
        if read["landed_bad_rows"] or read["landed_lost_rows"] or store.exists(f"quarantine.{entity}"):
            store.overwrite(f"quarantine.{entity}", quarantined(lines, key))

    for entity in SNAPSHOTS:
        snapshot(entity)
    load("activity", lambda rows: add_activity(store, usable_records(rows)))
    load(
        "capacity_metrics",
        lambda rows: merge_insert_only(
            store, "bronze.capacity_metrics", usable_records(rows), CAPACITY_KEYS
        ),
    )
    # Opaque until something reads it: kept as delivered.
    instances = spark.read.text(f"{landing}/datasource_instances")
    audit["bronze.datasource_instances"] = store.overwrite("bronze.datasource_instances", instances)
    audit["bronze.calendar"] = store.overwrite("bronze.calendar", calendar_hours(spark, today))
    return audit


def add_activity(
    store: TableStore, events: DataFrame, held: bool = False, indexed_from: int = INDEXED_FROM_BYTES
) -> int:
    """New events into the history, which lies by day. Ids are compared over the
    whole history: an event may come again with another time. A history of
    ``indexed_from`` bytes or more is asked by its key index, a smaller one is read.
    ``held``: the caller keeps the events stored meanwhile."""
    dated = events.withColumn(EVENT_DATE, F.to_date(parse_timestamp("CreationTime")))
    index = None
    if store.exists(name := "bronze.activity") and store.bytes(name) >= indexed_from:
        index = KeyIndex(store, name, ACTIVITY_KEYS, near=EVENT_DATE)
    return merge_insert_only(
        store,
        name,
        dated,
        ACTIVITY_KEYS,
        merge_copies=True,
        partition_by=[EVENT_DATE],
        held=held,
        index=index,
    )


def skipped(store: TableStore, today: dt.date) -> DataFrame:
    """kind, key of what the extraction left out: workspaces and items without an
    access list, days of the activity window without an event."""

    def without(parents: str, children: str, key: str) -> DataFrame:
        ids = usable_records(store.read(f"bronze.{parents}")).select(F.col("id").alias(key))
        left = parents_without_children(ids.where(F.col(key).isNotNull()), store.read(f"bronze.{children}"), key)
        return left.select(F.lit(children).alias("kind"), F.col(key).cast("string").alias("key"))

    first, end = (F.lit(b.date()) for b in activity_window(today))
    days = store.spark.range(1).select(F.explode(F.sequence(first, F.date_sub(end, 1))).alias(EVENT_DATE))
    quiet = parents_without_children(days, store.read("bronze.activity"), EVENT_DATE)
    quiet = quiet.select(F.lit("activity").alias("kind"), F.col(EVENT_DATE).cast("string").alias("key"))
    lists = without("workspaces", "workspace_access", "workspaceId")
    return lists.unionByName(without("items", "item_access", "itemId")).unionByName(quiet)


def build_typed(store: TableStore, since: dt.date | None = None) -> None:
    """Typed tables. All are rebuilt but the activity, of which ``since`` limits
    the work to its days from then on (and the events without a day). With ``since``
    a table made from a raw table that has not been written since stays too."""
    keep = since is not None
    for entity in TYPED_COLUMNS:
        if entity == "activity":
            continue
        raw = usable_records(store.read(f"bronze.{entity}"))
        _derived(store, f"silver.{entity}", f"bronze.{entity}", typed_table(entity, raw), keep)
    events = _days_from(store.read("bronze.activity"), since)
    _write_days(store, "silver.activity", dated_activity(events), since)
    _write_actor_days(store, since)
    store.overwrite("silver.users", merged_identities(store, keep))
    scan = usable_records(store.read("bronze.workspace_scan"))
    _derived(store, "silver.lineage", "bronze.workspace_scan", lineage_edges(scan), keep)
    store.overwrite("silver.calendar", calendar_table(store.read("bronze.calendar")))


def _derived(
    store: TableStore, name: str, source: str, rows: DataFrame, keep: bool, into: TableStore | None = None
) -> None:
    """A table made from one other alone. ``keep``: it stays as it is, with its counts, if
    that one has not been written since."""
    into = into or store
    written = store.made(source).get("write")
    made = into.made(name) if keep else {}
    if written and made.get("source") == written:
        into.audit[name] = made["counts"]
        return
    counts = into.overwrite(name, rows)
    if written:
        into.note(name, written, counts)


def dated_activity(raw: DataFrame) -> DataFrame:
    """Typed events with the day they lie under."""
    return typed_table("activity", raw).withColumn(EVENT_DATE, F.to_date("creation_time"))


def _write_actor_days(store: TableStore, since: dt.date | None) -> None:
    """Who acted on which day, from the days just written; from all days if there is no
    such table yet."""
    if not store.index.exists(ACTOR_DAYS):
        since = None
    seen = identity.actor_days(_days_from(store.read("silver.activity"), since), EVENT_DATE)
    if since is None:
        store.index.overwrite(ACTOR_DAYS, seen, [EVENT_DATE], gather=True)
    else:
        store.index.replace_partitions(ACTOR_DAYS, seen, [EVENT_DATE])


def _days_from(events: DataFrame, since: dt.date | None) -> DataFrame:
    day = F.col(EVENT_DATE)
    return events if since is None else events.where((day >= F.lit(since)) | day.isNull())


def _write_days(store: TableStore, name: str, rows: DataFrame, since: dt.date | None) -> None:
    if since is None:
        # a table of resolved actors may have been joined by shuffle
        store.overwrite(name, rows, [EVENT_DATE], gather=name.startswith("gold."))
    else:
        store.replace_partitions(name, rows, [EVENT_DATE])


def merged_identities(store: TableStore, keep: bool = False) -> DataFrame:
    """Principals of all sources, from the distinct descriptions of each, which are stored
    beside the tables and with ``keep`` stay where the source has stayed."""
    found = []
    for entity, principals in PRINCIPALS.items():
        rows = principals(usable_records(store.read(f"bronze.{entity}"))).distinct()
        _derived(store, name := f"principals.{entity}", f"bronze.{entity}", rows, keep, store.index)
        found.append(store.index.read(name))
    return identity.merge_identities(found)


def build_star(store: TableStore, since: dt.date | None = None) -> None:
    """Dimensions first: facts are joined to the written tables, whose size is
    known then. With ``since`` the days from then on are written, and earlier
    days with an event whose actor is named otherwise now than when they were."""

    def typed(name: str) -> DataFrame:
        return store.read(f"silver.{name}")

    def gold(name: str, rows: DataFrame) -> DataFrame:
        store.overwrite(f"gold.{name}", rows)
        return store.read(f"gold.{name}")

    gold("dim_workspace", workspace_dimension(typed("workspaces"), typed("capacities")))
    inventory = gold(
        "dim_inventory",
        item_dimension(typed("items"), typed("workspaces"), typed("capacities")),
    )
    seen = store.index.read(ACTOR_DAYS)
    users = typed("users")
    actors = gold("dim_user", users.unionByName(identity.unnamed_actors(seen, users)))
    keys = gold("next_actor_keys", identity.actor_keys(actors))
    if not store.exists("gold.actor_keys"):
        since = None
    events = typed("activity")
    if since is not None:
        changed = identity.changed_keys(store.read("gold.actor_keys"), keys)
        events = _days_touched(events, seen, since, changed)
    _write_days(store, "gold.fact_activity", identity.with_actor(events, keys), since)
    # last, so that a run that broke off finds the same changes again
    gold("actor_keys", keys)
    gold("fact_lineage", lineage_targets(typed("lineage"), inventory))


def _days_touched(events: DataFrame, seen: DataFrame, since: dt.date, changed: DataFrame) -> DataFrame:
    """Events of the days from ``since`` on, without a day, or with an actor whose key
    has changed. Which days these are is looked up among the actors by day."""
    named = seen.where(F.col(EVENT_DATE) < F.lit(since)).join(changed, "key", "left_semi")
    days = [r[0] for r in named.select(EVENT_DATE).distinct().collect()]  # one a day at most
    return events.where((F.col(EVENT_DATE) >= F.lit(since)) | F.col(EVENT_DATE).isNull() | F.col(EVENT_DATE).isin(days))


def build_all(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    today: dt.date,
    paged: Iterable[str] = (),
    since: dt.date | None = None,
) -> dict[str, dict[str, int]]:
    """All three layers from the files of one extraction; returns the row counts
    of all writes.

    Without ``since`` typed and star activity are rebuilt over the whole
    history. A daily run may give the first day of the activity window, since
    no extraction brings older events. ``bronze.skipped`` tells what the
    extraction left out. With ``since`` a snapshot whose landed files are the same as
    before stays as it is, and so do the tables made from it alone; a run without it
    makes them all again, as one after a change of their rules must.
    """
    landed_counts = build_raw(spark, landing, store, today, paged, keep=since is not None)
    store.overwrite("bronze.skipped", skipped(store, today))
    build_typed(store, since)
    build_star(store, since)
    return {**store.audit, **landed_counts}


def star_table(store: TableStore, name: str) -> DataFrame:
    same = SAME_AS_TYPED.get(name)
    return store.read(f"silver.{same}" if same else f"gold.{name}").drop(EVENT_DATE)


def star_model(store: TableStore, **lookup_options) -> StarModel:
    return StarModel({t: star_table(store, t) for t in STAR_TABLES}, lookup_options)
