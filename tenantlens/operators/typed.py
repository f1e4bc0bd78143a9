"""Typed tables: one landed source each, same grain, no cross-source joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantlens.functions.columns import null_before, parse_timestamp
from tenantlens.schemas import TYPED_COLUMNS


def project(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Selected fields under new names; dotted paths flatten nested fields."""
    return rows.select(*[F.col(path).alias(name) for name, path in columns.items()])


def typed_table(entity: str, raw: DataFrame) -> DataFrame:
    """Typed form of a landed source; see ``TYPED_COLUMNS`` for its columns."""
    table = project(raw, TYPED_COLUMNS[entity])
    if entity == "items":
        return table.withColumn(
            "item_last_updated", null_before(parse_timestamp("item_last_updated"))
        )
    if entity == "activity":
        return table.withColumn("creation_time", parse_timestamp("creation_time"))
    if entity == "item_access":
        return explode_permissions(table)
    return table


def explode_permissions(access: DataFrame) -> DataFrame:
    """(item, principal, permission list) to one row per permission; a missing
    or empty list gives no row."""
    others = [c for c in access.columns if c != "permissions"]
    return access.select(*others, F.explode("permissions").alias("permission"))
