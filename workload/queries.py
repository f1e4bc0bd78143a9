"""One query per operator. Each takes (session, folder of test tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantlens.functions.predicates import Contains, HalfOpen, Known, OneOf
from tenantlens.operators import identity
from tenantlens.operators.aggregates import flag_range_percent, flag_threshold, hourly_summary
from tenantlens.operators.history import (
    CAPACITY_KEYS,
    activity_window,
    capacity_window,
    in_window,
    merge_insert_only,
)
from tenantlens.operators.lineage import lineage_edges
from tenantlens.operators.typed import explode_permissions
from tenantlens.plans import reports
from tenantlens.plans.audit import activity_by_day
from tenantlens.plans.build import EVENT_DATE, add_activity, build_all, dated_activity, star_table
from tenantlens.plans.measures import MEASURES, Measure, evaluate
from tenantlens.schemas import NEXT_PAGE_OF, RAW_DDL
from tenantlens.session import scratch_dir
from tenantlens.sources.calendar import calendar_hours
from tenantlens.sources.landing import (
    RECORD,
    attach_parent_keys,
    broken_lists,
    flatten_pages,
    import_tabular,
    parents_without_children,
    parse_records,
    read_pages,
    read_records,
    record_fields,
    usable_records,
)
from tenantlens.sources.tables import preview
from tenantlens.streaming.activity import activity_stream
from workload.standins import RECORDS, Governance

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LANDED_RECORDS = 500_000  # in a compressed landed file


def query(name: str):
    """Registers a query; its result gets the plain types both engines share
    (bigint for integers, timestamps without zone)."""

    def register(build: Callable[[Governance], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _plain(build(Governance(spark, folder)))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        return build

    return register


def _plain(rows: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return rows.select(*[column(f) for f in rows.schema.fields])


# --- Sources and sinks --------------------------------------------------------


@query("ingest_json")
def _(g: Governance) -> DataFrame:
    """Records with two fields that the schema does not name, typed afterwards from the
    whole record, and the number of fields each record was delivered with."""
    landing = scratch_dir(g.spark, "landing")
    delivered = g.source("events").select(
        *[F.expr(e).alias(n) for n, e in RECORDS["activity"][1].items()],
        F.expr("named_struct('k', get_json_object(props, '$.k'), 'kind', event_type)").alias("Client"),
        F.expr("if(event_id % 3 = 0, NULL, floor(value * 8) / 8)").alias("Amount"),
    )
    delivered.write.mode("overwrite").json(landing)
    _broken_lines(g).write.mode("append").text(landing)
    g.store.overwrite("bronze.activity", usable_records(read_records(g.spark, landing, RAW_DDL["activity"])))
    later = {"client_k": ("$.Client.k", "bigint"), "amount": ("$.Amount", "double")}
    records = record_fields(g.store.read("bronze.activity"), later)
    return records.select(
        F.col("Id").alias("activity_id"),
        F.col("UserId").alias("user_id"),
        F.col("UserType").alias("user_type"),
        F.col("Workload").alias("workload"),
        F.col("IsSuccess").alias("is_success"),
        "client_k",
        "amount",
        F.size(F.json_object_keys(F.to_json(RECORD))).alias("n_fields"),
    )


def _broken_lines(g: Governance) -> DataFrame:
    """Lines that break off behind the id of an event."""
    some = g.raw("activity").where("pmod(hash(Id), 50) = 0")
    return some.select(F.concat(F.lit('{"Id": "'), "Id", F.lit('", "Work')).alias("value"))


def _user_pages(g: Governance, size: int) -> DataFrame:
    """Users in pages of at most ``size``, each with the link of the next and its own, one
    list per nation."""
    users = g.source("customer").select(
        F.struct(*[F.expr(e).alias(n) for n, e in RECORDS["directory_users"][1].items()]).alias("user"),
        F.col("c_nationkey").cast("string").alias("list"),
        F.expr(f"c_custkey div {size}").alias("span"),
    )
    spans = users.groupBy("list", "span").agg(F.collect_list("user").alias("value"))
    in_list = Window.partitionBy("list").orderBy("span")
    link = F.concat(F.lit("https://users?skip="), "list", F.lit("-"), "span")
    return spans.select(
        "list",
        F.row_number().over(in_list).alias("page"),
        "value",
        F.lead(link).over(in_list).alias("@odata.nextLink"),
        F.when(F.row_number().over(in_list) > 1, link).alias("_requested"),
    )


@query("flatten_pages")
def _(g: Governance) -> DataFrame:
    """Pages of users, their lists spread over files, flattened; each user has itself whole."""
    landing = scratch_dir(g.spark, "pages")
    _user_pages(g, 500).drop("list", "page").repartition(7).write.mode("overwrite").json(landing)
    ddl, token = RAW_DDL["directory_users"], NEXT_PAGE_OF["directory_users"]
    pages = read_pages(g.spark, landing, "value", ddl, token=token, whole=True)
    if not broken_lists(pages).isEmpty():
        raise ValueError("a list is broken")
    flat = record_fields(flatten_pages(pages, "value"), {"kind": ("$.userType", "string")})
    return flat.select(
        "id", F.col("displayName").alias("display_name"), "mail",
        F.col("userPrincipalName").alias("user_principal_name"),
        F.when(F.col("kind") == F.col("userType"), F.col("kind")).alias("user_type"),
    )


@query("page_chains")
def _(g: Governance) -> DataFrame:
    """Lists of pages over many files, some pages of which never came: the pieces left."""
    landing = scratch_dir(g.spark, "chains")
    pages = _user_pages(g, 20).where("pmod(cast(list as int) * 7 + page * 5, 11) <> 3")
    pages.repartition(16).write.mode("overwrite").json(landing)
    found = read_pages(
        g.spark, landing, "value", RAW_DDL["directory_users"], ["list"], NEXT_PAGE_OF["directory_users"]
    )
    return broken_lists(found, ["list"]).select("list", "fault", "pages")


@query("attach_parent_keys")
def _(g: Governance) -> DataFrame:
    """Child lists per workspace, in pages of at most 1,000 orders."""
    orders = g.source("orders").select("o_orderkey", "o_custkey")
    children = orders.select(
        F.expr("concat('ws', o_custkey div 16)").alias("workspaceId"),
        F.expr("o_orderkey div 1000").alias("page"),
        F.struct(
            F.concat(F.lit("u"), "o_custkey").alias("graphId"),
            F.col("o_orderkey").alias("grant_no"),
        ).alias("child"),
    )
    responses = children.groupBy("workspaceId", "page").agg(F.collect_list("child").alias("value"))
    return attach_parent_keys(responses, "value", {"workspace_id": "workspaceId"}).select(
        "workspace_id", F.col("graphId").alias("principal_id"), "grant_no"
    )


@query("parents_without_children")
def _(g: Governance) -> DataFrame:
    parents = g.raw("workspaces").select(F.col("id").alias("workspaceId"), "name")
    left = parents_without_children(parents, g.raw("workspace_access"), "workspaceId")
    return left.select(F.col("workspaceId").alias("workspace_id"), F.col("name").alias("workspace_name"))


@query("import_tabular")
def _(g: Governance) -> DataFrame:
    delivered = hourly_summary(
        g.raw("usage"), "ts", [], {"BackgroundPct": "background_pct", "InteractivePct": "interactive_pct"}
    ).select(
        F.col("date").cast("timestamp").alias("Day"),
        F.date_format("start_of_hour", "yyyy-MM-dd HH:mm:ss").alias("Start of hour"),
        "BackgroundPct",
        "InteractivePct",
    )
    return import_tabular(
        delivered,
        {
            "Day": "date",
            "Start of hour": "start_of_hour",
            "BackgroundPct": "background_pct",
            "InteractivePct": "interactive_pct",
        },
        {"date": "date", "start_of_hour": "timestamp"},
        {"capacity_id": "cap0"},
    )


@query("calendar_hours")
def _(g: Governance) -> DataFrame:
    """The year up to the day of the newest event."""
    return calendar_hours(g.spark, g.today)


@query("table_full_refresh")
def _(g: Governance) -> DataFrame:
    """Second refresh replaces the rows and the columns of the first."""
    g.store.overwrite("silver.workspace_access", g.raw("workspace_access"))
    return g.stored("silver.workspace_access", g.typed("workspace_access"))


@query("merge_insert_only")
def _(g: Governance) -> DataFrame:
    """Two extracts of the audit log that overlap by four days; some events come
    again with another day or without one."""
    events = g.raw("activity")
    first = events.where("CreationTime < '2024-01-17' OR CreationTime = 'not a date'")
    second = events.where("CreationTime >= '2024-01-13'").withColumn("CreationTime", _other_time())
    for origin, batch in (("first", first), ("second", second), ("again", second)):
        add_activity(g.store, batch.withColumn("origin", F.lit(origin)))
    return g.store.read("bronze.activity").select(F.col("Id").alias("activity_id"), "origin")


def _other_time():
    return F.expr(
        "CASE pmod(hash(Id), 5) WHEN 0 THEN 'not a date' WHEN 1 THEN '2024-02-20T00:00:00' ELSE CreationTime END"
    )


@query("merge_key_index")
def _(g: Governance) -> DataFrame:
    """The same extracts, with the history asked by its key index."""
    events = g.raw("activity")
    first = events.where("CreationTime < '2024-01-17' OR CreationTime = 'not a date'")
    second = events.where("CreationTime >= '2024-01-13'").withColumn("CreationTime", _other_time())
    for origin, batch in (("first", first), ("second", second), ("again", second)):
        add_activity(g.store, batch.withColumn("origin", F.lit(origin)), indexed_from=0)
    return g.store.read("bronze.activity").select(F.col("Id").alias("activity_id"), "origin")


@query("merge_composite_key")
def _(g: Governance) -> DataFrame:
    """Two extracts of hourly use that overlap by four days."""
    hours = g.capacity_hours()
    first = hours.where("date < DATE'2024-01-17'")
    second = hours.where("date >= DATE'2024-01-13'")
    for origin, batch in (("first", first), ("second", second)):
        merge_insert_only(
            g.store, "bronze.capacity_metrics", batch.withColumn("origin", F.lit(origin)), CAPACITY_KEYS
        )
    return g.store.read("bronze.capacity_metrics")


@query("rolling_window")
def _(g: Governance) -> DataFrame:
    events = g.source("events").where(in_window(F.col("ts"), activity_window(g.today)))
    return events.select("event_id", "ts")


@query("row_audit")
def _(g: Governance) -> DataFrame:
    """Counts taken while the typed access tables are written."""
    for entity in ("workspace_access", "item_access", "activity"):
        g.store.overwrite(f"silver.{entity}", g.typed(entity))
    counts = [(name, count["rows"]) for name, count in g.store.audit.items()]
    return g.spark.createDataFrame(counts, "table_name STRING, row_count BIGINT")


@query("audit_by_day")
def _(g: Governance) -> DataFrame:
    """Events by day as landed, typed and in the star schema, with their digests compared."""
    add_activity(g.store, g.raw("activity"))
    g.store.overwrite("silver.activity", dated_activity(g.store.read("bronze.activity")), [EVENT_DATE])
    facts = identity.resolve_actor(g.store.read("silver.activity"), g.gold("dim_user"))
    g.store.overwrite("gold.fact_activity", facts, [EVENT_DATE], gather=True)
    return activity_by_day(g.store)


@query("preview_topn")
def _(g: Governance) -> DataFrame:
    return preview(g.typed("capacity_metrics"), "date", "start_of_hour", "capacity_id")


# --- Projections, filters, predicates ----------------------------------------


@query("project_rename")
def _(g: Governance) -> DataFrame:
    return g.typed("tenant_settings")


@query("flatten_struct")
def _(g: Governance) -> DataFrame:
    return g.typed("items").select("item_id", "folder_id", "creator_name", "creator_type")


@query("optional_field")
def _(g: Governance) -> DataFrame:
    """Principals as JSON text, most of them without the optional field."""
    texts = g.raw("item_access").select("itemId", F.to_json("principal").alias("text"))
    ddl = "id STRING, type STRING, userDetails STRUCT<userPrincipalName: STRING>"
    records = usable_records(parse_records(texts, "text", ddl, ["itemId"]), ["itemId"])
    return records.select(
        F.col("itemId").alias("item_id"),
        F.col("id").alias("principal_id"),
        F.col("userDetails.userPrincipalName").alias("user_principal_name"),
    )


@query("parse_timestamp")
def _(g: Governance) -> DataFrame:
    return g.typed("activity").select("activity_id", "creation_time")


@query("sentinel_to_null")
def _(g: Governance) -> DataFrame:
    return g.typed("items").select("item_id", "item_last_updated")


@query("normalize_code")
def _(g: Governance) -> DataFrame:
    rows = identity.principals_of_item_access(g.raw("item_access"))
    return rows.select("principal_id", "principal_type", "email")


@query("conditional_null")
def _(g: Governance) -> DataFrame:
    return identity.principals_of_workspace_access(g.raw("workspace_access"))


@query("coalesce_cols")
def _(g: Governance) -> DataFrame:
    return identity.principals_of_directory(g.raw("directory_users"))


@query("filter_eq")
def _(g: Governance) -> DataFrame:
    chosen = (F.col("item_name") == "small ring") & (F.col("item_type") == "SemanticModel")
    return g.typed("items").where(chosen).select("item_id", "workspace_id")


@query("filter_in")
def _(g: Governance) -> DataFrame:
    listed = OneOf(("space 3", "space 7", None)).on(F.col("workspace_name"))
    return g.typed("activity").where(listed).select("activity_id", "workspace_name")


@query("filter_known")
def _(g: Governance) -> DataFrame:
    known = {"dim_tenant_setting.delegate_to_capacity": Known()}
    return reports.table(g.star(), "settings", known)


@query("filter_date_range")
def _(g: Governance) -> DataFrame:
    days = HalfOpen("2024-01-10", "2024-01-12").on(F.col("creation_time"))
    return g.typed("activity").where(days).select("activity_id", "creation_time")


@query("search_values")
def _(g: Governance) -> DataFrame:
    found = Contains("RinG").on(F.col("value"))
    return reports.slicer_values(g.star(), ["dim_tenant_setting.title"], found)


# --- Layer build --------------------------------------------------------------


@query("build_since")
def _(g: Governance) -> DataFrame:
    """Landed files through all layers, then a second day whose run rebuilds the days from
    its ``since`` on: the directory has grown, so that earlier days change as well."""
    landing, cut = scratch_dir(g.spark, "landing"), "2024-01-20"

    def land(entity: str, rows: DataFrame, mode: str = "overwrite") -> None:
        # compressed files are read by one task each, so none holds more than a task should parse
        packed = {"compression": "gzip", "maxRecordsPerFile": LANDED_RECORDS}
        rows.write.mode(mode).options(**packed).json(f"{landing}/{entity}")

    for entity in ("capacities", "workspaces", "items", "workspace_access", "item_access", "tenant_settings", "workspace_scan"):
        land(entity, g.raw(entity))
    land("capacity_metrics", g.capacity_hours())
    g.spark.range(1).select(F.lit("{}").alias("value")).write.text(f"{landing}/datasource_instances")
    users, events = g.raw("directory_users"), g.raw("activity")
    late = F.expr("CAST(substr(id, 2) AS BIGINT) % 10 = 3")
    before = F.expr(f"CreationTime < '{cut}' OR CreationTime = 'not a date'")
    land("directory_users", users.where(~late))
    land("activity", events.where(before))
    build_all(g.spark, landing, g.store, g.today)
    land("directory_users", users.where(late), "append")
    land("activity", events.where(~before), "append")
    build_all(g.spark, landing, g.store, g.today, since=dt.date.fromisoformat(cut))
    facts = star_table(g.store, "fact_activity").select("activity_id", "creation_time", "principal_id", "user_id_raw")
    actors = star_table(g.store, "dim_user").select(F.col("principal_id").alias("of"), "principal_type")
    return facts.join(actors, F.col("principal_id") == F.col("of"), "left").drop("of")


# --- Joins and identity -------------------------------------------------------


@query("dim_inventory")
def _(g: Governance) -> DataFrame:
    return g.make("dim_inventory")


@query("dim_workspace")
def _(g: Governance) -> DataFrame:
    return g.make("dim_workspace")


@query("merge_identities")
def _(g: Governance) -> DataFrame:
    return g.users()


@query("known_keys")
def _(g: Governance) -> DataFrame:
    return identity.known_keys(g.stored("silver.users", g.users()))


@query("service_actors")
def _(g: Governance) -> DataFrame:
    return identity.service_actors(g.typed("activity"), g.stored("silver.users", g.users()))


@query("dim_user")
def _(g: Governance) -> DataFrame:
    return g.make("dim_user")


@query("resolve_actor")
def _(g: Governance) -> DataFrame:
    return g.make("fact_activity")


@query("explode_permissions")
def _(g: Governance) -> DataFrame:
    lists = g.raw("item_access").select(
        F.col("itemId").alias("item_id"),
        F.col("principal.id").alias("principal_id"),
        F.col("itemAccessDetails.permissions").alias("permissions"),
    )
    return explode_permissions(lists)


@query("edges_nested")
def _(g: Governance) -> DataFrame:
    return lineage_edges(g.raw("workspace_scan"), ["DatasourceUsage"])


@query("edges_union")
def _(g: Governance) -> DataFrame:
    return g.edges()


@query("lineage_targets")
def _(g: Governance) -> DataFrame:
    return g.make("fact_lineage")


@query("distinct_values")
def _(g: Governance) -> DataFrame:
    return g.typed("activity").select("user_id").distinct()


# --- Time ---------------------------------------------------------------------


@query("calendar_attrs")
def _(g: Governance) -> DataFrame:
    return g.typed("calendar")


@query("hourly_summary")
def _(g: Governance) -> DataFrame:
    """The fourteen complete days before the newest event's day."""
    sums = {"background_pct": "background_pct", "interactive_pct": "interactive_pct"}
    return hourly_summary(
        g.raw("usage"), "ts", ["capacity_id"], sums, capacity_window(g.today), ordered=True
    )


@query("spine_capacity")
def _(g: Governance) -> DataFrame:
    return reports.capacity_by_hour(g.star())


@query("capacity_matrix")
def _(g: Governance) -> DataFrame:
    return reports.capacity_matrix(g.star())


@query("flag_range_percent")
def _(g: Governance) -> DataFrame:
    hours = _hour_averages(g)
    return flag_range_percent(hours, "avg_background_pct", "background_flag")


@query("flag_threshold")
def _(g: Governance) -> DataFrame:
    return flag_threshold(_hour_averages(g), "avg_interactive_pct", "interactive_flag")


def _hour_averages(g: Governance) -> DataFrame:
    return (
        g.gold("fact_capacity_metrics")
        .groupBy("date", "start_of_hour")
        .agg(
            F.avg("background_pct").alias("avg_background_pct"),
            F.avg("interactive_pct").alias("avg_interactive_pct"),
        )
    )


# --- Measures -----------------------------------------------------------------


@query("measures_totals")
def _(g: Governance) -> DataFrame:
    return reports.report_card(g.star(), "inventory")


@query("measures_capacity")
def _(g: Governance) -> DataFrame:
    return reports.report_card(g.star(), "capacity")


@query("measures_users")
def _(g: Governance) -> DataFrame:
    return reports.report_card(g.star(), "security")


@query("measures_activity")
def _(g: Governance) -> DataFrame:
    return reports.report_card(g.star(), "activity")


@query("measure_override")
def _(g: Governance) -> DataFrame:
    """A saved choice of successes only: failures keep their own filter."""
    chosen = {"fact_activity.is_success": OneOf((True,))}
    return reports.report_card(g.star(), "activity", chosen)


@query("measure_by_principal_type")
def _(g: Governance) -> DataFrame:
    """Groups on a related table, filters on the facts and on a related table,
    and one on a table that does not relate to the facts."""
    context = {
        "fact_activity.workload": OneOf(("W1", "W2", "W3")),
        "dim_user.principal_type": OneOf(("User", "Service", None)),
        "dim_date.is_weekend": OneOf((True,)),
    }
    names = ["total_activities", "total_failed_activities", "pct_failed_activities"]
    return evaluate(g.star(), names, context, ["dim_user.principal_type"])


@query("distinct_over_relation")
def _(g: Governance) -> DataFrame:
    """Distinct actors and operations beside a sum, by an attribute of a related table and
    under a filter on it."""
    measures = MEASURES | {
        "distinct_actors": Measure("fact_activity", "distinct", "principal_id"),
        "distinct_workspaces": Measure("fact_activity", "distinct", "workspace_name"),
    }
    names = ["distinct_actors", "total_activities", "distinct_workspaces"]
    context = {"fact_activity.workload": OneOf(("W1", "W2")), "dim_user.principal_type": OneOf(("User", "Service", None))}
    return evaluate(g.star(), names, context, ["dim_user.principal_type"], measures=measures)


@query("activity_matrix")
def _(g: Governance) -> DataFrame:
    return reports.activity_matrix(g.star())


# --- Report tables ------------------------------------------------------------


@query("report_inventory")
def _(g: Governance) -> DataFrame:
    return reports.table(g.star(), "inventory")


@query("report_settings")
def _(g: Governance) -> DataFrame:
    return reports.table(g.star(), "settings")


@query("report_workspace_access")
def _(g: Governance) -> DataFrame:
    return reports.table(g.star(), "workspace_access")


@query("report_principals")
def _(g: Governance) -> DataFrame:
    return reports.table(g.star(), "principals")


@query("star_item_access")
def _(g: Governance) -> DataFrame:
    return reports.table(g.star(), "item_access")


@query("report_activity")
def _(g: Governance) -> DataFrame:
    return reports.table(g.star(), "activity")


@query("report_lineage")
def _(g: Governance) -> DataFrame:
    relations = {"fact_lineage.relationship_type": OneOf(("DependsOnDataset", "DatasourceUsage"))}
    return reports.table(g.star(), "lineage", relations)


@query("slicer_values")
def _(g: Governance) -> DataFrame:
    names = [n for page in reports.SLICERS.values() for n in page]
    return reports.slicer_values(g.star(), list(dict.fromkeys(names)))


@query("slicer_context")
def _(g: Governance) -> DataFrame:
    """All slicers while three of them are set."""
    names = [n for page in reports.SLICERS.values() for n in page]
    chosen = {
        "dim_workspace.capacity_name": OneOf(("NATION_1", "NATION_4", "NATION_8", "NATION_12", "NATION_20")),
        "dim_user.principal_type": OneOf(("User", "Service")),
        "fact_activity.workload": OneOf(("W1", "W3")),
    }
    return reports.slicer_values(g.star(), list(dict.fromkeys(names)), filters=chosen)


# --- Streaming ----------------------------------------------------------------


@query("activity_stream")
def _(g: Governance) -> DataFrame:
    """Landed events, half of them landed twice, some with an unreadable time,
    and broken lines, through the stream."""
    landing = scratch_dir(g.spark, "stream-landing")
    events = g.raw("activity")
    events.write.mode("append").json(landing)
    again = events.where("CreationTime >= '2024-01-13'")
    unreadable = F.expr("if(pmod(hash(Id), 5) = 0, 'unreadable', CreationTime)")
    again.withColumn("CreationTime", unreadable).write.mode("append").json(landing)
    _broken_lines(g).write.mode("append").text(landing)
    stream = activity_stream(g.spark, landing, g.store, scratch_dir(g.spark, "stream-checkpoint"))
    stream.awaitTermination()
    history = g.store.read("bronze.activity")
    return history.select(
        F.col("Id").alias("activity_id"),
        F.col("CreationTime").alias("creation_time"),
        F.col("IsSuccess").alias("is_success"),
    )
