"""Report queries: tables, matrices, cards and slicer values of the six pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.operators.aggregates import (
    flag_threshold,
    leaf_average,
    leaf_groups,
    level_groups,
    range_bound,
    subtotals,
)
from tenantlens.plans.measures import card, evaluate
from tenantlens.plans.star import Filters, StarModel, base_table, split_name

# --- Fixed values: columns of each table visual -------------------------------
TABLES = {
    "inventory": (
        "dim_inventory.capacity_name",
        "dim_inventory.workspace_name",
        "dim_inventory.item_type",
        "dim_inventory.item_name",
        "dim_inventory.item_state",
        "dim_inventory.creator_type",
        "dim_inventory.creator_name",
    ),
    "settings": (
        "dim_tenant_setting.tenant_setting_group",
        "dim_tenant_setting.title",
        "dim_tenant_setting.setting_name",
        "dim_tenant_setting.enabled",
        "dim_tenant_setting.can_specify_security_groups",
        "dim_tenant_setting.delegate_to_capacity",
        "dim_tenant_setting.delegate_to_domain",
        "dim_tenant_setting.delegate_to_workspace",
    ),
    "workspace_access": (
        "dim_workspace.workspace_name",
        "fact_workspace_access.role",
        "dim_user.display_name",
        "dim_user.email",
    ),
    "principals": (
        "dim_user.principal_type",
        "dim_user.display_name",
        "dim_user.email",
    ),
    "item_access": (
        "dim_workspace.workspace_name",
        "fact_item_access.item_type",
        "dim_inventory.item_name",
        "fact_item_access.permission",
        "fact_item_access.principal_type",
        "fact_item_access.principal_display_name",
        "fact_item_access.user_principal_name",
    ),
    "activity": (
        "fact_activity.workspace_name",
        "fact_activity.activity",
        "fact_activity.activity_id",
        "fact_activity.creation_time",
        "fact_activity.user_type",
        "fact_activity.workload",
        "fact_activity.is_success",
        "fact_activity.item_name",
        "dim_user.principal_type",
        "dim_user.email",
    ),
    "lineage": (
        "dim_inventory.workspace_name",
        "dim_inventory.item_type",
        "dim_inventory.item_name",
        "fact_lineage.target_type",
        "fact_lineage.target_name",
        "fact_lineage.relationship_type",
    ),
}

# --- Fixed values: leading sort column of the visuals that are sorted ---------
SORTED_BY = {
    "inventory": "item_state",
    "settings": "tenant_setting_group",
    "activity": "creation_time",
    "lineage": "workspace_name",
}

# --- Fixed values: slicer columns of each page --------------------------------
SLICERS = {
    "inventory": (
        "dim_workspace.capacity_name",
        "dim_workspace.workspace_name",
        "dim_inventory.creator_name",
        "dim_inventory.item_state",
        "dim_inventory.item_name",
        "dim_inventory.item_type",
    ),
    "tenant": (
        "dim_tenant_setting.delegate_to_domain",
        "dim_tenant_setting.delegate_to_workspace",
        "dim_tenant_setting.delegate_to_capacity",
        "dim_tenant_setting.tenant_setting_group",
        "dim_tenant_setting.setting_name",
        "dim_tenant_setting.title",
        "dim_tenant_setting.enabled",
    ),
    "capacity": ("dim_date.date",),
    "security": (
        "dim_user.principal_type",
        "fact_item_access.item_type",
        "fact_item_access.principal_type",
        "fact_workspace_access.role",
        "dim_workspace.workspace_name",
        "fact_item_access.permission",
    ),
    "activity": (
        "fact_activity.activity",
        "fact_activity.workload",
        "fact_activity.workspace_name",
        "fact_activity.is_success",
        "dim_user.principal_type",
        "fact_activity.creation_time",
    ),
    "lineage": (
        "dim_inventory.item_name",
        "dim_inventory.item_type",
        "dim_inventory.workspace_name",
    ),
}

# --- Fixed values: measures of each card --------------------------------------
CARDS = {
    "inventory": ("total_capacities", "total_workspaces", "total_items"),
    "capacity": ("hours_over_100_pct_cu", "background_cu_pct", "interactive_cu_pct"),
    "security": (
        "total_users",
        "total_service_principals",
        "total_app_principals",
        "total_security_groups",
    ),
    "activity": ("total_activities", "total_failed_activities", "pct_failed_activities"),
}


# --- Fixed values: slicers that pick a range; they offer its two ends ----------
RANGE_SLICERS = ("dim_date.date", "fact_activity.creation_time")


def table(model: StarModel, name: str, filters: Filters | None = None) -> DataFrame:
    """Distinct rows of a table visual, sorted as it is.

    Rows are dealt out once, by ranges of all columns behind the sort column
    (of few values alone, one would fill a task). Equal rows meet there, so
    copies leave and the rest is sorted without a further shuffle.
    """
    names = TABLES[name]
    base = base_table(split_name(n)[0] for n in names)
    rows = model.flat(base, names, filters).toDF(*[split_name(n)[1] for n in names])
    if name not in SORTED_BY:
        return rows.distinct()
    first = SORTED_BY[name]
    order = [first, *[c for c in rows.columns if c != first]]
    return rows.repartitionByRange(*order).distinct().sortWithinPartitions(*order)


def report_card(model: StarModel, page: str, filters: Filters | None = None) -> DataFrame:
    return card(model, CARDS[page], filters)


def activity_matrix(model: StarModel, filters: Filters | None = None) -> DataFrame:
    """Activities per workspace, workload and operation with all subtotals."""
    levels = ("workspace_name", "workload", "operation")
    rows = _base_rows(model, "fact_activity", levels, filters)
    return subtotals(rows, levels, counts=["total_activities"])


def capacity_matrix(model: StarModel, filters: Filters | None = None) -> DataFrame:
    """Average use per date and hour with subtotals; hours are flagged."""
    levels = ("date", "start_of_hour")
    values = ("background_pct", "interactive_pct")
    rows = _base_rows(model, "fact_capacity_metrics", (*levels, *values), filters)
    averages = {f"avg_{v}": v for v in values}
    leaves = leaf_groups(rows, levels, averages=averages)
    cells = level_groups(leaves, levels, averages=averages)
    is_hour = ~F.col("total_start_of_hour")
    flagged = cells.withColumn("_hours", F.when(is_hour, F.col("avg_background_pct")))
    bound = range_bound(leaves, leaf_average("avg_background_pct"))
    flagged = flagged.withColumn("background_flag", F.col("_hours") >= bound)
    return flag_threshold(
        flagged.withColumn("_hours", F.when(is_hour, F.col("avg_interactive_pct"))),
        "_hours",
        "interactive_flag",
    ).drop("_hours")


def capacity_by_hour(model: StarModel, filters: Filters | None = None) -> DataFrame:
    """Both sums for every calendar hour, newest first; hours without use stay."""
    by = ("dim_date.date", "dim_date.start_of_hour")
    names = ("background_cu_pct", "interactive_cu_pct")
    rows = evaluate(model, names, filters, by, show_all=True)
    return rows.orderBy(F.desc("date"), F.desc("start_of_hour"))


def slicer_values(
    model: StarModel,
    columns: Sequence[str],
    matching: Column | None = None,
    filters: Filters | None = None,
) -> DataFrame:
    """Values offered by slicers as rows ``(slicer, value)``, values as text: the
    distinct ones of a list, the smallest and largest of a range.

    The list slicers of a table are grouped together first; only the groups, one
    per combination of labels, are taken apart into single values.

    With ``filters`` a slicer offers the values of the rows that meet all of them but
    its own: a choice made in a slicer does not narrow that slicer.
    """
    by_table: dict[str, list[str]] = {}
    for name in columns:
        by_table.setdefault(split_name(name)[0], []).append(name)
    result = None
    for table_name, names in by_table.items():
        ranges = [n for n in names if n in RANGE_SLICERS]
        lists = [n for n in names if n not in ranges]
        if filters:
            values = _values_in_context(model, table_name, lists, ranges, filters)
            result = values if result is None else result.unionByName(values)
            continue
        rows, offered = model[table_name], []
        if lists:
            columns_of = [F.col(split_name(n)[1]).cast("string").alias(n) for n in lists]
            groups = rows.select(*columns_of).distinct()
            offered.append(groups.unpivot([], [F.col(f"`{n}`") for n in lists], "slicer", "value").distinct())
        for name in ranges:
            column = F.col(split_name(name)[1])
            ends = rows.agg(F.array_distinct(F.array(F.min(column), F.max(column))).alias("ends"))
            ends = ends.select(F.lit(name).alias("slicer"), F.explode("ends").alias("value"))
            offered.append(ends.select("slicer", F.col("value").cast("string").alias("value")))
        for values in offered:
            result = values if result is None else result.unionByName(values)
    return result if matching is None else result.where(matching)


def _values_in_context(
    model: StarModel, base: str, lists: Sequence[str], ranges: Sequence[str], filters: Filters
) -> DataFrame:
    """Values of all slicers of one table, each under the filters but its own, from one
    scan: a row whose mask lacks one bit counts for the slicer of that filter alone."""
    columns = {n: split_name(n)[1] for n in [*lists, *ranges]}
    rows, bits = model.unmet(base, filters, list(dict.fromkeys(columns.values())))
    labels = [F.col(columns[n]).cast("string").alias(f"_v{i}") for i, n in enumerate(lists)]
    ends = [end(columns[n]).alias(f"_{side}{i}") for i, n in enumerate(ranges) for side, end in (("min", F.min), ("max", F.max))]
    some = rows.where(F.bit_count("_unmet") <= 1)
    groups = some.groupBy(*labels, "_unmet")
    groups = groups.agg(*ends) if ends else groups.agg(F.lit(True).alias("_any"))

    def counts_for(name: str) -> Column:
        return F.col("_unmet").bitwiseAND(F.lit(~bits.get(name, 0)).cast("bigint")) == 0

    offered = []
    if lists:
        each = [
            F.when(counts_for(n), F.struct(F.lit(n).alias("slicer"), F.col(f"_v{i}").alias("value")))
            for i, n in enumerate(lists)
        ]
        found = groups.select(F.explode(F.array_compact(F.array(*each))).alias("_found"))
        offered.append(found.select("_found.*").distinct())
    for i, name in enumerate(ranges):
        low, high = (f(F.when(counts_for(name), F.col(f"_{side}{i}"))) for side, f in (("min", F.min), ("max", F.max)))
        values = groups.agg(F.array_distinct(F.array(low, high)).alias("ends"))
        values = values.select(F.lit(name).alias("slicer"), F.explode("ends").alias("value"))
        offered.append(values.select("slicer", F.col("value").cast("string").alias("value")))
    result = offered[0]
    for values in offered[1:]:
        result = result.unionByName(values)
    return result


def _base_rows(
    model: StarModel, base: str, columns: Sequence[str], filters: Filters | None
) -> DataFrame:
    return model.flat(base, [f"{base}.{c}" for c in columns], filters).toDF(*columns)
