"""The measures, evaluated in a filter context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantlens.functions.predicates import Above, IsFalseOrBlank, OneOf, Predicate
from tenantlens.plans.star import (
    RELATIONSHIPS,
    Filters,
    StarModel,
    path_between,
    reachable,
    split_name,
)
from tenantlens.schemas import APP_TYPE, FULL_CAPACITY_PCT, GROUP_TYPE, SERVICE_TYPE, USER_TYPE


@dataclass(frozen=True)
class Measure:
    """``kind`` is rows, sum or distinct. ``own`` holds predicates on columns of
    the base table; each replaces an outer filter on its column."""

    base: str
    kind: str
    column: str | None = None
    own: Mapping[str, Predicate] = field(default_factory=dict)


@dataclass(frozen=True)
class Ratio:
    """Safe division: an empty denominator gives NULL."""

    numerator: Measure
    denominator: Measure


_ACTIVITIES = Measure("fact_activity", "rows")
_FAILED = Measure("fact_activity", "rows", own={"is_success": IsFalseOrBlank()})


def _users_of_type(code: str) -> Measure:
    return Measure("dim_user", "rows", own={"principal_type": OneOf((code,))})


MEASURES: dict[str, Measure | Ratio] = {
    "total_activities": _ACTIVITIES,
    "total_failed_activities": _FAILED,
    "pct_failed_activities": Ratio(_FAILED, _ACTIVITIES),
    "background_cu_pct": Measure("fact_capacity_metrics", "sum", "background_pct"),
    "interactive_cu_pct": Measure("fact_capacity_metrics", "sum", "interactive_pct"),
    "hours_over_100_pct_cu": Measure(
        "fact_capacity_metrics", "rows", own={"background_pct": Above(FULL_CAPACITY_PCT)}
    ),
    "total_workspaces": Measure("dim_workspace", "rows"),
    "total_capacities": Measure("dim_workspace", "distinct", "capacity_id"),
    "total_items": Measure("dim_inventory", "rows"),
    "total_users": _users_of_type(USER_TYPE),
    "total_security_groups": _users_of_type(GROUP_TYPE),
    # actors that no source names; registered applications are counted apart
    "total_service_principals": _users_of_type(SERVICE_TYPE),
    "total_app_principals": _users_of_type(APP_TYPE),
}


def _leaves(measure: Measure | Ratio) -> tuple[Measure, ...]:
    if isinstance(measure, Ratio):
        return (measure.numerator, measure.denominator)
    return (measure,)


def evaluate(
    model: StarModel,
    names: Sequence[str],
    filters: Filters | None = None,
    by: Sequence[str] = (),
    *,
    show_all: bool = False,
    measures: Mapping[str, Measure | Ratio] = MEASURES,
) -> DataFrame:
    """Measures of one base table per group of the ``table.column`` names in
    ``by``; without ``by`` one row.

    Outer filters on tables the base does not refer to have no effect. One on a
    column some measure filters itself is dropped for that measure only, all
    in one pass over the base. If groups or filters lie on dimensions, the base
    is first aggregated by its foreign keys and the dimensions are joined to
    those groups, not to the facts.

    ``show_all`` keeps groups without facts (``by`` then names columns of one
    related dimension).
    """
    parts: list[Measure] = []
    for name in names:
        parts += [leaf for leaf in _leaves(measures[name]) if leaf not in parts]
    bases = {leaf.base for leaf in parts}
    if len(bases) != 1:
        raise ValueError(f"measures of several tables: {sorted(bases)}")
    base = bases.pop()

    effective = reachable(base, filters or {})
    overridable = {f"{base}.{c}" for leaf in parts for c in leaf.own}
    contested = {n: p for n, p in effective.items() if n in overridable}
    common = {n: p for n, p in effective.items() if n not in overridable}
    on_base = {n: p for n, p in common.items() if split_name(n)[0] == base}
    on_dimensions = {n: p for n, p in common.items() if n not in on_base}

    rows = model[base]
    for name, predicate in on_base.items():
        rows = rows.where(predicate.on(F.col(split_name(name)[1])))

    def context(leaf: Measure) -> Column | None:
        predicates = {split_name(n)[1]: p for n, p in contested.items()}
        predicates.update(leaf.own)
        condition = None
        for column, predicate in predicates.items():
            test = predicate.on(F.col(column))
            condition = test if condition is None else condition & test
        return condition

    base_groups = [split_name(n)[1] for n in by if split_name(n)[0] == base]
    outside = [n for n in by if split_name(n)[0] != base]
    joined = bool(outside or on_dimensions)
    if joined and any(leaf.kind == "distinct" for leaf in parts):
        return _with_distinct(model, names, filters, by, show_all, measures)

    partial = {f"_p{i}": _aggregate(leaf, context(leaf)) for i, leaf in enumerate(parts)}
    if joined:
        keys = _foreign_keys(base, [*outside, *on_dimensions])
        merged = rows.groupBy(*dict.fromkeys([*base_groups, *keys])).agg(
            *[c.alias(n) for n, c in partial.items()]
        )
        if show_all:
            flat = _all_groups(model, base, merged, by, on_dimensions, list(partial))
        else:
            one_row_per_key = not base_groups and len(set(keys)) == 1
            flat = model.with_table(base, merged).flat(
                base, [*by, *[f"{base}.{p}" for p in partial]], on_dimensions, merged=one_row_per_key
            )
        groups = [F.col(f"`{n}`").alias(split_name(n)[1]) for n in by]
        result = flat.groupBy(*groups).agg(
            *[F.sum(F.col(f"`{base}.{p}`")).alias(p) for p in partial]
        )
    else:
        result = rows.groupBy(*base_groups).agg(*[c.alias(n) for n, c in partial.items()])

    values = {}
    for i, leaf in enumerate(parts):
        value = _across_own_groups(result, f"_p{i}", leaf, by)
        blank_is_zero = leaf.kind != "sum" and not show_all
        values[i] = F.coalesce(value, F.lit(0)) if blank_is_zero else value
    columns = []
    for name in names:
        picked = [values[parts.index(leaf)] for leaf in _leaves(measures[name])]
        column = F.try_divide(*picked) if len(picked) == 2 else picked[0]
        columns.append(column.alias(name))
    return result.select(*[split_name(n)[1] for n in by], *columns)


def _with_distinct(
    model: StarModel,
    names: Sequence[str],
    filters: Filters | None,
    by: Sequence[str],
    show_all: bool,
    measures: Mapping[str, Measure | Ratio],
) -> DataFrame:
    """Measures of which some count distinct values over related tables. Sums are merged
    by foreign key; distinct values are not sums, so they are reduced to one row per
    value, foreign keys and groups of the base first. These rows are joined to the
    dimensions and counted there; no row of the facts is."""
    apart = [n for n in names if any(leaf.kind == "distinct" for leaf in _leaves(measures[n]))]
    if show_all or any(isinstance(measures[n], Ratio) for n in apart):
        raise ValueError("distinct counts over related tables stand for themselves and have no empty groups")
    together = [n for n in names if n not in apart]
    columns = [split_name(n)[1] for n in by]
    results = [evaluate(model, together, filters, by, measures=measures)] if together else []
    for name in apart:
        results.append(_distinct_over(model, name, measures[name], filters or {}, by))
    whole = results[0]
    for more in results[1:]:
        if not columns:
            whole = whole.crossJoin(more)  # one row each
            continue
        told = more.toDF(*[f"_{c}" if c in columns else c for c in more.columns])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
        whole = whole.join(told, same, "full")
        keys = [F.coalesce(c, f"_{c}").alias(c) for c in columns]
        whole = whole.select(*keys, *[c for c in whole.columns if c.lstrip("_") not in columns])
    filled = [F.coalesce(n, F.lit(0)).alias(n) if n in apart else F.col(n) for n in names]
    return whole.select(*columns, *filled)


def _distinct_over(model: StarModel, name: str, leaf: Measure, filters: Filters, by: Sequence[str]) -> DataFrame:
    effective = {n: p for n, p in reachable(leaf.base, filters).items() if n not in {f"{leaf.base}.{c}" for c in leaf.own}}
    own = {f"{leaf.base}.{c}": p for c, p in leaf.own.items()}
    rows = model[leaf.base]
    on_dimensions = {}
    for key, predicate in {**effective, **own}.items():
        table, column = split_name(key)
        if table == leaf.base:
            rows = rows.where(predicate.on(F.col(column)))
        else:
            on_dimensions[key] = predicate
    outside = [n for n in by if split_name(n)[0] != leaf.base]
    groups = [split_name(n)[1] for n in by if split_name(n)[0] == leaf.base]
    keys = _foreign_keys(leaf.base, [*outside, *on_dimensions])
    values = rows.select(*dict.fromkeys([leaf.column, *groups, *keys])).distinct()
    value = f"{leaf.base}.{leaf.column}"
    flat = model.with_table(leaf.base, values).flat(leaf.base, [*by, value], on_dimensions)
    named = [F.col(f"`{n}`").alias(split_name(n)[1]) for n in by]
    column = F.col(f"`{value}`")
    blank = F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    return flat.groupBy(*named).agg((F.count_distinct(column) + blank).alias(name))


def _across_own_groups(
    result: DataFrame, part: str, leaf: Measure, by: Sequence[str]
) -> Column:
    """A group is an outer filter too: where the measure filters the grouping
    column itself, every group shows the value over all of that column."""
    others = [split_name(n)[1] for n in by if n not in {f"{leaf.base}.{c}" for c in leaf.own}]
    if len(others) == len(by):
        return F.col(part)
    if leaf.kind == "distinct":
        raise ValueError("a distinct count cannot be merged over groups")
    if others:
        return F.sum(part).over(Window.partitionBy(*others))
    return result.agg(F.sum(part)).scalar()


def _aggregate(leaf: Measure, condition: Column | None) -> Column:
    if leaf.kind == "rows":
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    value = F.col(leaf.column)
    kept = value if condition is None else F.when(condition, value)
    if leaf.kind == "sum":
        return F.sum(kept)
    # A blank is one more distinct value.
    blank = value.isNull() if condition is None else condition & value.isNull()
    return F.count_distinct(kept) + F.coalesce(F.max(blank.cast("int")), F.lit(0))


def _foreign_keys(base: str, names: Sequence[str]) -> list[str]:
    keys = []
    for name in names:
        path = path_between(base, split_name(name)[0])
        if path is None:
            raise ValueError(f"{base} does not relate to {name}")
        keys.append(RELATIONSHIPS[(path[0], path[1])][0])
    return keys


def _all_groups(
    model: StarModel,
    base: str,
    merged: DataFrame,
    by: Sequence[str],
    filters: Filters,
    partial: Sequence[str],
) -> DataFrame:
    """Every row of the one dimension in ``by`` that meets its filters, with the
    merged facts of its key if there are any. Facts whose key no row has follow
    under blank members, unless a filter on the dimension leaves them out."""
    tables = {split_name(n)[0] for n in [*by, *filters]}
    if len(tables) != 1 or (base, next(iter(tables))) not in RELATIONSHIPS:
        raise ValueError("show_all needs groups of one related dimension")
    dimension = tables.pop()
    many_key, one_key = RELATIONSHIPS[(base, dimension)]
    members = model[dimension]
    for name, predicate in filters.items():
        members = members.where(predicate.on(F.col(split_name(name)[1])))
    columns = dict.fromkeys([one_key, *[split_name(n)[1] for n in by]])
    members = members.select(*[F.col(c).alias(f"{dimension}.{c}") for c in columns])
    facts = merged.select(
        F.col(many_key).alias("_fk"), *[F.col(p).alias(f"{base}.{p}") for p in partial]
    )
    same = F.col(f"`{dimension}.{one_key}`") == F.col("_fk")
    return members.join(facts, same, "left" if filters else "full")


def card(
    model: StarModel,
    names: Sequence[str],
    filters: Filters | None = None,
) -> DataFrame:
    """Measures as rows ``(measure, value)``; tables with several measures are
    read once."""
    by_base: dict[str, list[str]] = {}
    for name in names:
        by_base.setdefault(_leaves(MEASURES[name])[0].base, []).append(name)
    result = None
    for group in by_base.values():
        wide = evaluate(model, group, filters).select(
            *[F.col(n).cast("double").alias(n) for n in group]
        )
        long = wide.unpivot([], group, "measure", "value")
        result = long if result is None else result.unionByName(long)
    return result
