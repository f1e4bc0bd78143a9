"""Aggregations with their partial results merged before anything is expanded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.operators.history import in_window
from tenantlens.schemas import INTERACTIVE_FLAG_PCT, RANGE_FLAG_SHARE


def subtotals(
    rows: DataFrame,
    levels: Sequence[str],
    *,
    counts: Sequence[str] = (),
    averages: Mapping[str, str] | None = None,
) -> DataFrame:
    """Hierarchical matrix: every group of every level down to the grand total.

    ``counts`` names row-count columns, ``averages`` maps an output column to
    the column averaged. ``total_<level>`` is true where the level is summed
    over, which tells a subtotal from a member that is NULL.

    Leaf groups are aggregated first; the level expansion then runs over the
    leaf groups instead of over every row.
    """
    leaves = leaf_groups(rows, levels, counts=counts, averages=averages)
    return level_groups(leaves, levels, counts=counts, averages=averages)


def leaf_groups(
    rows: DataFrame,
    levels: Sequence[str],
    *,
    counts: Sequence[str] = (),
    averages: Mapping[str, str] | None = None,
) -> DataFrame:
    """The innermost groups, with what their averages are merged from."""
    parts = {f"_n_{name}": F.count(F.lit(1)) for name in counts}
    for name, column in (averages or {}).items():
        parts[f"_s_{name}"] = F.sum(column)
        parts[f"_k_{name}"] = F.count(column)
    return rows.groupBy(*levels).agg(*[c.alias(n) for n, c in parts.items()])


def level_groups(
    leaves: DataFrame,
    levels: Sequence[str],
    *,
    counts: Sequence[str] = (),
    averages: Mapping[str, str] | None = None,
) -> DataFrame:
    """The groups of all levels, merged from the leaves."""
    return leaves.rollup(*levels).agg(
        *[(F.grouping(level) == 1).alias(f"total_{level}") for level in levels],
        *[F.coalesce(F.sum(f"_n_{name}"), F.lit(0)).alias(name) for name in counts],
        *[_merged_average(name).alias(name) for name in averages or {}],
    )


def leaf_average(name: str) -> Column:
    return F.try_divide(F.col(f"_s_{name}"), F.col(f"_k_{name}"))


def _merged_average(name: str) -> Column:
    return F.try_divide(F.sum(f"_s_{name}"), F.sum(f"_k_{name}"))


def hourly_summary(
    usage: DataFrame,
    ts: str,
    keys: Sequence[str],
    sums: Mapping[str, str],
    bounds: tuple[dt.datetime, dt.datetime] | None = None,
    *,
    ordered: bool = False,
) -> DataFrame:
    """Sums per day and start of hour (and further keys), in time order if asked."""
    if bounds:
        usage = usage.where(in_window(F.col(ts), bounds))
    hours = usage.groupBy(*keys, F.date_trunc("hour", ts).alias("start_of_hour")).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )
    hours = hours.select(F.to_date("start_of_hour").alias("date"), "start_of_hour", *keys, *sums)
    return hours.orderBy("date", "start_of_hour", *keys) if ordered else hours


def flag_range_percent(
    groups: DataFrame, column: str, flag: str, share: float = RANGE_FLAG_SHARE
) -> DataFrame:
    """Marks groups whose value reaches ``min + share * (max - min)`` over all
    groups."""
    return groups.withColumn(flag, F.col(column) >= range_bound(groups, F.col(column), share))


def range_bound(groups: DataFrame, value: Column, share: float = RANGE_FLAG_SHARE) -> Column:
    """``min + share * (max - min)`` of a value over all groups, as a scalar
    subquery: the groups stay where they are.

    The subquery reads every column of the groups, though it needs one. So its
    plan for the groups is the same as that of the query around it, and what
    they shuffle is computed once and read twice.
    """
    low, high = F.min(value), F.max(value)
    whole = F.max(F.struct(*[F.col(f"`{c}`") for c in groups.columns]))
    both = F.struct((low + F.lit(share) * (high - low)).alias("bound"), whole.alias("whole"))
    return groups.agg(both.alias("found")).scalar()["bound"]


def flag_threshold(
    groups: DataFrame, column: str, flag: str, bound: float = INTERACTIVE_FLAG_PCT
) -> DataFrame:
    return groups.withColumn(flag, F.col(column) >= F.lit(bound))
