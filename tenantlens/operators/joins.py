"""Joins of many rows to a dimension or a key list, safe for hot and missing keys.

How the rows of a join are kept apart: rows without a key, and rows of hot keys
(about ``HOT_KEY_ROWS`` rows or more; of those keys the largest whose rows fit
into ``HOT_BYTES``), meet nothing in the shuffle. They are dealt out over all
tasks by a second join column, the slot. What a hot key would have met is
broadcast instead, at most one row per hot key. All other keys are joined by
shuffle, so the result is whole whatever keys are taken for hot ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEY_ROWS = 1_000_000
HOT_BYTES = BROADCAST_BYTES
SAMPLED_ROWS_PER_HOT_KEY = 1_000


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type two key columns are compared in: their own if it is one, the
    wider one of two whole-number types. Other pairs are refused, whichever way
    the join would go."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
        return max(left, right, key=lambda t: order.index(type(t)))
    if isinstance(left, T.StringType) and isinstance(right, T.StringType):
        return T.StringType()
    raise TypeError(f"keys of different types: {left.simpleString()}, {right.simpleString()}")


def common_types(left: DataFrame, right: DataFrame, keys: list[str]) -> dict[str, T.DataType]:
    return {k: common_type(left.schema[k].dataType, right.schema[k].dataType) for k in keys}


def _row_bytes(rows: DataFrame) -> Column:
    """Bytes of a row: text by its length, other values 16 each, plus 16."""
    size = F.lit(16)
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
        else:
            size = size + 16
    return size.cast("bigint")


def stored_bytes(rows: DataFrame) -> int:
    """Bytes of the given rows, counted, not estimated."""
    return rows.agg(F.sum(_row_bytes(rows)).alias("bytes")).first()["bytes"] or 0


def _rows_within(rows: DataFrame, budget: int) -> int:
    """How many rows fit into a budget, were they all as large as the largest."""
    widest = rows.agg(F.max(_row_bytes(rows)).alias("bytes")).first()["bytes"] or 16
    return max(1, budget // widest)


def slot(*keys: Column) -> Column:
    """Second join column, the same on both sides wherever the keys are."""
    return F.xxhash64(*keys)


def spread_slot(rows: DataFrame, apart: Column, *keys: Column) -> Column:
    """``slot`` of the keys, but for rows marked ``apart`` a value of their own
    that deals them out over all tasks.

    The value depends on the row and its task only, so a task that is run again
    after a lost executor deals the same rows to the same places. A constant in
    its place would not do: the optimizer takes a constant out of the join keys.
    """
    hashable = [
        F.col(f"`{f.name}`") for f in rows.schema.fields if not holds_unordered(f.dataType)
    ]
    dealt = F.xxhash64(*hashable, F.spark_partition_id())
    return F.when(apart, dealt).otherwise(slot(*keys))


def holds_unordered(data_type: T.DataType) -> bool:
    """Whether values of the type hold maps or variants: these are neither hashed nor ordered."""
    if isinstance(data_type, T.StructType):
        return any(holds_unordered(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return holds_unordered(data_type.elementType)
    return isinstance(data_type, (T.MapType, T.VariantType))


def _crowded_keys(keyed: DataFrame, hot_key_rows: int, max_hot_keys: int) -> list[Row]:
    """Largest keys by an estimate of their rows, the missing key among them.

    A key that is hot shows in a small share of the rows, so only that share is
    counted; of the rows nothing but the key is read. The list only decides
    which way rows take, never which rows there are.
    """
    share = min(1.0, SAMPLED_ROWS_PER_HOT_KEY / hot_key_rows)
    keys = keyed.select("_key")
    if share < 1.0:
        keys = keys.sample(share, seed=1)
    return (
        keys.groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= math.ceil(share * hot_key_rows))
        .orderBy(F.desc("_n"))
        .limit(max_hot_keys + 1)
        .select("_key")
        .collect()
    )


def _hot_frame(keyed: DataFrame, crowded: list[Row]) -> DataFrame:
    """The crowded keys but the missing one."""
    hot = [(r["_key"],) for r in crowded if r["_key"] is not None]
    schema = T.StructType([T.StructField("_key", keyed.schema["_key"].dataType)])
    return F.broadcast(keyed.sparkSession.createDataFrame(hot, schema))


def left_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: Column | str,
    dimension_key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_key_rows: int = HOT_KEY_ROWS,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Every fact row with the other columns of its dimension row, or NULLs.

    The dimension is unique on its key. If its counted size is within
    ``broadcast_bytes`` the facts are joined where they lie. If not, both sides
    are shuffled by key, with hot and missing keys kept apart.
    """
    key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    taken = [c for c in dimension.columns if c != dimension_key]
    clash = set(taken) & set(facts.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    # Both sides of one type: equal keys must have equal slots.
    key_type = common_type(facts.select(key).schema[0].dataType, dimension.schema[dimension_key].dataType)
    keyed = facts.select("*", key.cast(key_type).alias("_key"))
    lookup = dimension.select(
        F.col(dimension_key).cast(key_type).alias("_key"),
        F.struct(F.lit(True).alias("_found"), *[F.col(f"`{c}`") for c in taken]).alias("_row"),
    )

    if stored_bytes(dimension) <= broadcast_bytes:
        joined = keyed.join(F.broadcast(lookup), "_key", "left")
        row = F.col("_row")
    elif not (crowded := _crowded_keys(keyed, hot_key_rows, _rows_within(dimension, hot_bytes))):
        joined = keyed.join(lookup, "_key", "left")
        row = F.col("_row")
    else:
        hot_keys = _hot_frame(keyed, crowded)
        hot_rows = lookup.join(hot_keys, "_key", "left_semi")
        hot = hot_keys.join(F.broadcast(hot_rows), "_key", "left").select(
            "_key", F.lit(True).alias("_hot"), F.col("_row").alias("_hot_row")
        )
        marked = keyed.join(F.broadcast(hot), "_key", "left")
        apart = F.col("_key").isNull() | F.col("_hot").isNotNull()
        marked = marked.withColumn("_slot", spread_slot(facts, apart, F.col("_key")))
        cold = lookup.withColumn("_slot", slot(F.col("_key")))
        joined = marked.join(cold, ["_key", "_slot"], "left")
        row = F.coalesce(F.col("_hot_row"), F.col("_row"))
    return joined.select(
        *[F.col(f"`{c}`") for c in facts.columns], *[row.getField(c).alias(c) for c in taken]
    )


def without_match(
    rows: DataFrame,
    present: DataFrame,
    keys: list[str],
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Rows whose key no row of ``present`` has. A key with a missing part
    equals nothing.

    Both sides may hold many copies of a key: those of ``present`` are merged
    on the way into the join, those of ``rows`` are kept apart as hot keys.
    """
    columns = [F.col(f"`{k}`") for k in keys]
    common = common_types(rows, present, keys)
    typed = F.struct(*[F.col(f"`{k}`").cast(t).alias(k) for k, t in common.items()])
    complete = F.lit(True)
    for column in columns:
        complete = complete & column.isNotNull()
    keyed = rows.select("*", F.when(complete, typed).alias("_key"))
    listed = present.select(typed.alias("_key"))
    crowded = _crowded_keys(keyed, hot_key_rows, _rows_within(rows.select(*columns), hot_bytes))
    if not crowded:
        left = keyed.join(listed.distinct(), "_key", "left_anti")
        return left.select(*[F.col(f"`{c}`") for c in rows.columns])

    # Merged by both join columns: the join needs no further shuffle of them.
    listed = listed.withColumn("_slot", slot(F.col("_key"))).dropDuplicates(["_key", "_slot"])
    hot_keys = _hot_frame(keyed, crowded)
    there = listed.join(hot_keys, "_key", "left_semi").select(
        "_key", F.lit(True).alias("_there")
    )
    hot = hot_keys.join(F.broadcast(there), "_key", "left").select(
        "_key", F.lit(True).alias("_hot"), "_there"
    )
    marked = keyed.join(F.broadcast(hot), "_key", "left").where(F.col("_there").isNull())
    apart = F.col("_key").isNull() | F.col("_hot").isNotNull()
    marked = marked.withColumn("_slot", spread_slot(rows, apart, F.col("_key")))
    left = marked.join(listed, ["_key", "_slot"], "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in rows.columns])
