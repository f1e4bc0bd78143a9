"""Lineage as a list of edges: one row per relation between two assets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.operators.joins import left_lookup
from tenantlens.schemas import EXTERNAL_TARGET_LABEL

EDGE_COLUMNS = (
    "workspace_id",
    "source_type",
    "source_id",
    "source_name",
    "relationship_type",
    "target_type",
    "target_id",
)


def _listed(array: Column) -> Column:
    return F.coalesce(array, F.array())


def _edge(node: Column, source_type: str, relation: str, target_type: str, target: Column) -> Column:
    return F.struct(
        F.lit(source_type).alias("source_type"),
        node["id"].alias("source_id"),
        node["name"].alias("source_name"),
        F.lit(relation).alias("relationship_type"),
        F.lit(target_type).alias("target_type"),
        target.alias("target_id"),
    )


def _usages() -> Column:
    """Dataset -> data source, one per entry of the doubly nested usage list."""

    def of(node: Column) -> Column:
        found = _listed(node["datasourceUsages"]["datasourceInstanceId"])
        return F.transform(found, lambda t: _edge(node, "Dataset", "DatasourceUsage", "Datasource", t))

    return F.flatten(F.transform(_listed(F.col("datasets")), of))


def _report_links() -> Column:
    """Report -> dataset, for reports that name one."""
    linked = F.filter(_listed(F.col("reports")), lambda r: r["datasetId"].isNotNull())
    return F.transform(linked, lambda r: _edge(r, "Report", "DependsOnDataset", "Dataset", r["datasetId"]))


# A further relation is one more entry.
EDGE_KINDS = {"DatasourceUsage": _usages, "DependsOnDataset": _report_links}


def lineage_edges(scan: DataFrame, kinds: Sequence[str] = tuple(EDGE_KINDS)) -> DataFrame:
    """Edges of the given relations, all unpacked from one read of the scan."""
    found = F.concat(*[EDGE_KINDS[kind]() for kind in kinds])
    edges = scan.select(F.col("id").alias("workspace_id"), F.explode(found).alias("_edge"))
    return edges.select("workspace_id", "_edge.*").select(*EDGE_COLUMNS)


def lineage_targets(edges: DataFrame, inventory: DataFrame, **lookup_options) -> DataFrame:
    """Edges with the name of their target, or the label of an outside source.

    Many edges may point at one data source; ``left_lookup`` takes care of it.
    """
    names = inventory.select("item_id", F.col("item_name").alias("_target_name"))
    facts = edges.select("source_id", "relationship_type", "target_id", "target_type")
    named = left_lookup(facts, names, "target_id", "item_id", **lookup_options)
    return named.select(
        *facts.columns,
        F.coalesce("_target_name", F.lit(EXTERNAL_TARGET_LABEL)).alias("target_name"),
    )
