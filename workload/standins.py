"""Landed governance records derived from the test tables.

The test tables hold trade data. Each entity is a projection of one of them
into the landed shape of ``tenantlens.schemas.RAW_DDL``; from there on the
library's own functions do the work, as they would on real landed records.

    capacities        nation      one row each
    workspaces        supplier    some without capacity, some of an unknown one
    items             part        sixteen per workspace, the last of no workspace
    workspace_access  orders      a customer's access to a workspace
    item_access       lineitem    a principal's permission list on an item
    directory_users   customer
    activity          events      user ids in four spellings, some missing
    tenant_settings   part
    workspace_scan    part        data sets and reports with their links
    usage             events      capacity use, summed per hour by the library
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantlens.operators import identity
from tenantlens.operators.aggregates import hourly_summary
from tenantlens.operators.inventory import item_dimension, workspace_dimension
from tenantlens.operators.lineage import lineage_edges, lineage_targets
from tenantlens.operators.typed import typed_table
from tenantlens.plans.build import SAME_AS_TYPED, STAR_TABLES
from tenantlens.plans.star import StarModel
from tenantlens.session import scratch_dir
from tenantlens.sources.calendar import calendar_hours, calendar_table
from tenantlens.sources.tables import TableStore

# Landed field -> expression on the test table.
RECORDS: dict[str, tuple[str, dict[str, str]]] = {
    "capacities": (
        "nation",
        {
            "id": "concat('cap', n_nationkey)",
            "displayName": "n_name",
            "sku": "concat('F', (n_nationkey % 4 + 1) * 2)",
            "region": "concat('region ', n_regionkey)",
            "state": "'Active'",
        },
    ),
    "workspaces": (
        "supplier",
        {
            "id": "concat('ws', s_suppkey)",
            "name": "s_name",
            "type": "if(s_suppkey % 5 = 0, 'PersonalGroup', 'Workspace')",
            "state": "if(s_acctbal < 0, 'Deleted', 'Active')",
            "capacityId": (
                "CASE WHEN s_suppkey % 7 = 6 THEN NULL "
                "WHEN s_suppkey % 7 = 5 THEN concat('old', s_nationkey) "
                "ELSE concat('cap', s_nationkey) END"
            ),
        },
    ),
    "items": (
        "part",
        {
            "id": "concat('i', p_partkey)",
            "name": "p_name",
            "type": "elt(p_size % 4 + 1, 'Report', 'SemanticModel', 'Notebook', 'Lakehouse')",
            "state": "if(p_size % 10 = 0, 'Deleted', 'Active')",
            "lastUpdatedDate": (
                "CASE p_partkey % 5 WHEN 0 THEN '0001-01-01T00:00:00' "
                "WHEN 1 THEN 'not a date' WHEN 2 THEN NULL "
                "ELSE concat('2024-01-', lpad(p_size % 28 + 1, 2, '0'), 'T08:30:00') END"
            ),
            "workspaceId": "concat('ws', p_partkey div 16)",
            "folderId": "if(p_partkey % 3 = 0, concat('f', p_partkey div 100), NULL)",
            "creatorPrincipal": (
                "if(p_partkey % 6 = 0, NULL, named_struct('displayName', p_brand, "
                "'type', if(p_size % 3 = 0, 'ServicePrincipal', 'User')))"
            ),
        },
    ),
    "workspace_access": (
        "orders",
        {
            "workspaceId": "concat('ws', o_custkey div 16)",
            "graphId": (
                "CASE o_custkey % 10 WHEN 0 THEN concat('g', o_custkey % 50) "
                "WHEN 1 THEN concat('s', o_custkey div 16) ELSE concat('u', o_custkey) END"
            ),
            "displayName": (
                "if(o_orderpriority = '1-URGENT', NULL, concat('Person ', o_custkey))"
            ),
            "principalType": "CASE o_custkey % 10 WHEN 0 THEN 'Group' WHEN 1 THEN 'App' ELSE 'User' END",
            "identifier": "if(o_orderstatus = 'P', NULL, concat('Cust', o_custkey, '@x.org'))",
            "groupUserAccessRight": "o_orderpriority",
        },
    ),
    "item_access": (
        "lineitem",
        {
            "itemId": "concat(if(l_linenumber = 7, 'x', 'i'), l_partkey)",
            "workspaceId": "concat('ws', l_suppkey)",
            "principal": (
                "CASE l_linenumber % 3 "
                "WHEN 0 THEN named_struct('id', concat('s', l_suppkey), "
                "'displayName', concat('Robot ', l_suppkey), 'type', 'ServicePrincipal', "
                "'userDetails', CAST(NULL AS STRUCT<userPrincipalName: STRING>)) "
                "WHEN 1 THEN named_struct('id', concat('u', l_partkey), "
                "'displayName', concat('User ', l_partkey), 'type', 'User', "
                "'userDetails', named_struct('userPrincipalName', concat('user', l_partkey, '@x.org'))) "
                "ELSE named_struct('id', concat('g', l_suppkey % 50), "
                "'displayName', concat('Team ', l_suppkey % 50), 'type', 'Group', "
                "'userDetails', CAST(NULL AS STRUCT<userPrincipalName: STRING>)) END"
            ),
            "itemAccessDetails": (
                "named_struct('type', "
                "CASE l_returnflag WHEN 'A' THEN 'Report' WHEN 'N' THEN 'SemanticModel' ELSE 'Notebook' END, "
                "'permissions', CASE WHEN l_tax = 0 THEN NULL WHEN l_discount = 0 "
                "THEN CAST(array() AS ARRAY<STRING>) "
                "ELSE array_compact(array('Read', if(l_linestatus = 'O', 'Write', NULL), "
                "if(l_returnflag = 'A', 'Reshare', NULL))) END)"
            ),
        },
    ),
    "directory_users": (
        "customer",
        {
            "id": "concat('u', c_custkey)",
            "displayName": "c_name",
            "mail": "if(c_acctbal < 2000, NULL, concat(lower(c_mktsegment), c_custkey, '@x.org'))",
            "userPrincipalName": "concat('u', c_custkey, '@corp.org')",
            "userType": "if(c_nationkey = 0, 'Guest', 'Member')",
        },
    ),
    "activity": (
        "events",
        {
            "Id": "concat('a', event_id)",
            "CreationTime": (
                "if(event_id % 1000 = 999, 'not a date', "
                "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"))"
            ),
            "Operation": "event_type",
            "Activity": "concat(event_type, ' ', CAST(get_json_object(props, '$.k') AS INT) % 3)",
            "UserId": (
                "CASE WHEN event_id % 97 = 0 THEN NULL "
                "WHEN event_id % 4 = 0 THEN concat('U', user_id) "
                "WHEN event_id % 4 = 1 THEN concat('CUST', user_id, '@X.ORG') "
                "WHEN event_id % 8 = 2 THEN concat('Job', user_id % 9) "
                "WHEN event_id % 8 = 6 THEN concat('job', user_id % 9) "
                "ELSE concat('u', user_id, '@corp.org') END"
            ),
            "UserType": "user_id % 5",
            "Workload": "concat('W', CAST(get_json_object(props, '$.k') AS INT) % 5)",
            "ItemName": "concat('item ', CAST(get_json_object(props, '$.k') AS INT))",
            "WorkSpaceName": (
                "if(CAST(get_json_object(props, '$.k') AS INT) % 20 = 19, NULL, "
                "concat('space ', CAST(get_json_object(props, '$.k') AS INT) % 20))"
            ),
            "IsSuccess": (
                "if(event_type = 'signup' AND event_id % 11 = 0, NULL, event_type <> 'error')"
            ),
        },
    ),
    "tenant_settings": (
        "part",
        {
            "settingName": "concat('set', p_partkey)",
            "title": "p_name",
            "tenantSettingGroup": "p_brand",
            "enabled": "p_size % 2 = 0",
            "canSpecifySecurityGroups": "p_size % 3 = 0",
            "delegateToCapacity": "if(p_size % 3 = 0, NULL, p_size % 2 = 1)",
            "delegateToDomain": "if(p_size % 5 = 0, false, NULL)",
            "delegateToWorkspace": "if(p_size % 7 = 0, true, NULL)",
        },
    ),
    "workspace_scan": (
        "part",
        {
            "id": "concat('ws', p_partkey div 16)",
            "datasets": (
                "if(p_size % 4 = 1, array(named_struct('id', concat('i', p_partkey), 'name', p_name, "
                "'datasourceUsages', CASE p_size % 3 WHEN 0 THEN NULL "
                "WHEN 1 THEN array(named_struct('datasourceInstanceId', concat('d', p_size))) "
                "ELSE array(named_struct('datasourceInstanceId', concat('d', p_size)), "
                "named_struct('datasourceInstanceId', concat('d', p_size + 1))) END)), array())"
            ),
            "reports": (
                "if(p_size % 4 = 0, array(named_struct('id', concat('i', p_partkey), 'name', p_name, "
                "'datasetId', if(p_partkey % 3 = 0, NULL, concat('i', p_partkey - p_partkey % 16)))), NULL)"
            ),
        },
    ),
    # Values are cut to eighths: their sums are exact in any order.
    "usage": (
        "events",
        {
            # some hours lie before the calendar, some use has no hour
            "ts": (
                "CASE event_id % 500 WHEN 7 THEN ts - INTERVAL 800 DAYS WHEN 8 THEN NULL ELSE ts END"
            ),
            "capacity_id": "concat('cap', user_id % 3)",
            "background_pct": (
                "if(event_type IN ('view', 'click'), floor(value * 8) / 8, CAST(0 AS DOUBLE))"
            ),
            "interactive_pct": (
                "if(event_type IN ('view', 'click'), CAST(0 AS DOUBLE), floor(value * 8) / 8)"
            ),
        },
    ),
}


class Governance:
    """Landed, typed and star-schema tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def raw(self, entity: str) -> DataFrame:
        if entity == "capacity_metrics":
            return self.capacity_hours()
        table, fields = RECORDS[entity]
        return self.source(table).select(*[F.expr(e).alias(n) for n, e in fields.items()])

    def typed(self, entity: str) -> DataFrame:
        if entity == "calendar":
            return calendar_table(calendar_hours(self.spark, self.today))
        return typed_table(entity, self.raw(entity))

    @cached_property
    def store(self) -> TableStore:
        return TableStore(self.spark, scratch_dir(self.spark, "tables"))

    def stored(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows as a written table, as the build leaves them."""
        self.store.overwrite(name, rows)
        return self.store.read(name)

    @cached_property
    def today(self) -> dt.date:
        """The day of the newest event."""
        return self.source("events").agg(F.max("ts").cast("date").alias("d")).first()["d"]

    def capacity_hours(self) -> DataFrame:
        sums = {"background_pct": "background_pct", "interactive_pct": "interactive_pct"}
        return hourly_summary(self.raw("usage"), "ts", ["capacity_id"], sums)

    def users(self) -> DataFrame:
        return identity.merge_identities(
            [
                identity.principals_of_workspace_access(self.raw("workspace_access")),
                identity.principals_of_item_access(self.raw("item_access")),
                identity.principals_of_directory(self.raw("directory_users")),
            ]
        )

    def edges(self) -> DataFrame:
        return lineage_edges(self.raw("workspace_scan"))

    def dim_user(self) -> DataFrame:
        users = self.stored("silver.users", self.users())
        return identity.actor_dimension(users, self.typed("activity"))

    def make(self, table: str) -> DataFrame:
        """A table of the star schema from typed tables and stored dimensions."""
        if table == "dim_inventory":
            return item_dimension(
                self.typed("items"), self.typed("workspaces"), self.typed("capacities")
            )
        if table == "dim_workspace":
            return workspace_dimension(self.typed("workspaces"), self.typed("capacities"))
        if table == "dim_user":
            return self.dim_user()
        if table == "fact_activity":
            # written first: the keys are measured and looked up more than once
            keys = self.stored("silver.actor_keys", identity.actor_keys(self.gold("dim_user")))
            return identity.with_actor(self.typed("activity"), keys)
        if table == "fact_lineage":
            return lineage_targets(self.edges(), self.gold("dim_inventory"))
        return self.typed(SAME_AS_TYPED[table])

    def gold(self, table: str) -> DataFrame:
        """The written table, as reports find it; the first query that needs it
        writes it, the later ones of the session read it."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _BUILT:
            _BUILT[key] = TableStore(self.spark, scratch_dir(self.spark, "gold"))
        store, name = _BUILT[key], f"gold.{table}"
        if name not in store.audit:
            store.overwrite(name, self.make(table))
        return store.read(name)

    def star(self) -> StarModel:
        return StarModel(GoldTables(self))


_BUILT: dict[tuple[str, str], TableStore] = {}


class GoldTables(Mapping):
    """Star schema by name; a table is built when it is first asked for."""

    def __init__(self, governance: Governance):
        self._governance = governance

    def __getitem__(self, name: str) -> DataFrame:
        return self._governance.gold(name)

    def __iter__(self) -> Iterator[str]:
        return iter(STAR_TABLES)

    def __len__(self) -> int:
        return len(STAR_TABLES)
