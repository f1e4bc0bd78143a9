"""Star schema: tables, many-to-one relationships, and rows joined along them."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.functions.predicates import Predicate
from tenantlens.operators.joins import left_lookup

# --- Fixed values: the many side, the one side, and their key columns ---------
RELATIONSHIPS = {
    ("fact_activity", "dim_user"): ("principal_id", "principal_id"),
    ("fact_item_access", "dim_user"): ("principal_id", "principal_id"),
    ("dim_inventory", "dim_workspace"): ("workspace_id", "workspace_id"),
    ("fact_lineage", "dim_inventory"): ("source_id", "item_id"),
    ("fact_workspace_access", "dim_workspace"): ("workspace_id", "workspace_id"),
    ("fact_workspace_access", "dim_user"): ("principal_id", "principal_id"),
    ("fact_item_access", "dim_inventory"): ("item_id", "item_id"),
    ("fact_capacity_metrics", "dim_date"): ("start_of_hour", "start_of_hour"),
}

Filters = Mapping[str, Predicate]


def split_name(name: str) -> tuple[str, str]:
    table, _, column = name.partition(".")
    return table, column


def path_between(base: str, table: str) -> list[str] | None:
    """Tables from the many side to the one side, or None: filters pass from a
    dimension to the facts that refer to it, never the other way."""
    if base == table:
        return [base]
    for many, one in RELATIONSHIPS:
        if many == base:
            rest = path_between(one, table)
            if rest:
                return [base, *rest]
    return None


def base_table(tables: Iterable[str]) -> str:
    """The given or related table from which all given tables can be reached."""
    wanted = list(dict.fromkeys(tables))
    known = wanted + [many for many, _ in RELATIONSHIPS if many not in wanted]
    for candidate in known:
        if all(path_between(candidate, t) for t in wanted):
            return candidate
    raise ValueError(f"no table relates to all of {wanted}")


@dataclass
class StarModel:
    """Named tables of the star schema; ``lookup_options`` go to ``left_lookup``."""

    tables: Mapping[str, DataFrame]
    lookup_options: dict = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def with_table(self, name: str, rows: DataFrame) -> StarModel:
        return StarModel(ChainMap({name: rows}, self.tables), self.lookup_options)

    def flat(
        self,
        base: str,
        names: Sequence[str],
        filters: Filters | None = None,
        *,
        merged: bool = False,
    ) -> DataFrame:
        """Base rows with the named ``table.column`` columns under their full
        names, reduced to the rows that meet the filters.

        Related tables are left-joined with just the columns asked for; chains of
        dimensions are folded first, so the base is joined once to each table it
        refers to. Filters on the base apply before any join. ``merged`` says the
        base has one row per key, so that no key can be hot.
        """
        effective = reachable(base, filters or {})
        wanted: dict[str, set[str]] = {base: set()}
        parent: dict[str, str] = {}
        for table, column in map(split_name, [*names, *effective]):
            path = path_between(base, table)
            if path is None:
                raise ValueError(f"{base} does not relate to {table}")
            for many, one in zip(path, path[1:]):
                parent[one] = many
                wanted.setdefault(one, set())
                wanted[many].add(RELATIONSHIPS[(many, one)][0])
            wanted[table].add(column)

        rows = self[base].select(*[F.col(c).alias(f"{base}.{c}") for c in sorted(wanted[base])])
        rows = matching(rows, {n: p for n, p in effective.items() if split_name(n)[0] == base})

        def joined(rows: DataFrame, many: str) -> DataFrame:
            """The rows with the folded dimensions their table refers to."""
            for one in [t for t, p in parent.items() if p == many]:
                many_key, one_key = RELATIONSHIPS[(many, one)]
                dimension = self[one].select(
                    F.col(one_key).alias("_one"),
                    *[F.col(c).alias(f"{one}.{c}") for c in sorted(wanted[one])],
                )
                dimension = joined(dimension.withColumnRenamed("_one", f"_key_of_{one}"), one)
                reference, key = F.col(f"`{many}.{many_key}`"), f"_key_of_{one}"
                if merged and many == base:
                    rows = rows.join(dimension, reference == F.col(key), "left").drop(key)
                else:
                    rows = left_lookup(rows, dimension, reference, key, **self.lookup_options)
            return rows

        rows = joined(rows, base)
        rows = matching(rows, {n: p for n, p in effective.items() if split_name(n)[0] != base})
        return rows.select(*[F.col(f"`{n}`") for n in dict.fromkeys(names)])

    def unmet(self, base: str, filters: Filters, columns: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
        """Base rows with ``columns`` and ``_unmet``, a bit for each filter that the row
        does not meet; and the bit of each filter that reaches the base.

        A related table is brought as key and mask only, with the masks of the tables
        behind it folded in before. Rows without a related row get the mask of a row of
        blanks.
        """
        effective = reachable(base, filters)
        if len(effective) > 62:
            raise ValueError("more filters than a mask has bits")
        bits = {name: 1 << i for i, name in enumerate(effective)}
        return self._masked(base, {n: (p, bits[n]) for n, p in effective.items()}, list(columns)), bits

    def _masked(self, base: str, tests: Mapping[str, tuple[Predicate, int]], columns: list[str]) -> DataFrame:
        behind: dict[str, dict] = {}
        mask = F.lit(0).cast("bigint")
        for name, (predicate, bit) in tests.items():
            table, column = split_name(name)
            if table == base:
                mask = mask.bitwiseOR(_bit_unless(predicate, F.col(column), bit))
            else:
                behind.setdefault(path_between(base, table)[1], {})[name] = (predicate, bit)
        keys = [RELATIONSHIPS[(base, one)][0] for one in behind]
        rows = self[base].select(*dict.fromkeys([*columns, *keys]), mask.alias("_unmet"))
        for one, inner in behind.items():
            many_key, one_key = RELATIONSHIPS[(base, one)]
            side = self._masked(one, inner, [one_key])
            side = side.select(F.col(one_key).alias("_one"), F.col("_unmet").alias("_other"))
            blank = F.lit(0).cast("bigint")
            for name, (predicate, bit) in inner.items():
                table, column = split_name(name)
                nothing = F.lit(None).cast(self[table].schema[column].dataType)
                blank = blank.bitwiseOR(_bit_unless(predicate, nothing, bit))
            rows = left_lookup(rows, side, many_key, "_one", **self.lookup_options)
            both = F.col("_unmet").bitwiseOR(F.coalesce("_other", blank))
            rows = rows.withColumn("_unmet", both).drop("_other")
        return rows.select(*columns, "_unmet")


def _bit_unless(predicate: Predicate, column: Column, bit: int) -> Column:
    return F.when(predicate.on(column), F.lit(0).cast("bigint")).otherwise(F.lit(bit).cast("bigint"))


def reachable(base: str, filters: Filters) -> dict[str, Predicate]:
    """The filters that have an effect on the base table."""
    return {n: p for n, p in filters.items() if path_between(base, split_name(n)[0])}


def matching(rows: DataFrame, filters: Filters) -> DataFrame:
    """Rows that meet all filters; columns carry full names."""
    for name, predicate in filters.items():
        rows = rows.where(predicate.on(F.col(f"`{name}`")))
    return rows
