"""Item and workspace dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenantlens.operators.joins import left_lookup


def workspace_dimension(
    workspaces: DataFrame, capacities: DataFrame, **lookup_options
) -> DataFrame:
    """Workspaces with their capacity; those without one stay."""
    return left_lookup(workspaces, capacities, "capacity_id", "capacity_id", **lookup_options)


def item_dimension(
    items: DataFrame, workspaces: DataFrame, capacities: DataFrame, **lookup_options
) -> DataFrame:
    """Items with their workspace and its capacity; items without either stay.

    The capacity is attached to the workspaces, not to the items: the longer
    side is joined once.
    """
    described = workspace_dimension(workspaces, capacities, **lookup_options)
    return left_lookup(items, described, "workspace_id", "workspace_id", **lookup_options)
