"""Rows of groups in order, without bringing a group into one task.

Rows are dealt out by ranges of (group, order), so a large group lies in several
tasks, one after the other. A task meets most groups whole. Groups at its edges,
which may go on in the next task, and groups beyond a bound of rows or bytes come
in blocks, numbered within the task: (part, block) is their order in the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantlens.llm.common import sliced

BLOCK_ROWS = 4_096
BLOCK_BYTES = 8 << 20


class Stretch(NamedTuple):
    key: object
    part: int
    block: int
    whole: bool
    columns: dict[str, list]


def dealt(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows in ranges of ``order``; rows equal in all of it are dealt out as well."""
    keyed = rows.withColumn("_tie", F.monotonically_increasing_id())
    return keyed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")


def stretches(
    batches: Iterator[pa.RecordBatch], key: str, most_rows: int = BLOCK_ROWS, most_bytes: int = BLOCK_BYTES
) -> Iterator[Stretch]:
    """Whole groups, and blocks of those that may not be whole, of sorted rows."""
    part = TaskContext.get().partitionId()
    held: dict[str, list] = {}
    rows = size = block = 0
    current, edge, started = None, True, False

    def out(whole: bool) -> Stretch:
        nonlocal held, rows, size, block
        made = Stretch(current, part, block, whole, held)
        held, rows, size, block = {}, 0, 0, block + 1
        return made

    for batch in sliced(batches, most_rows):
        columns = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "_tie"}
        keys = columns[key]
        cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        each = batch.nbytes // max(1, len(keys))
        for at, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if at == end:
                continue
            if started and keys[at] != current:
                if rows:
                    yield out(not edge)
                edge = False
            current, started = keys[at], True
            if rows and (rows + end - at > most_rows or size + each * (end - at) > most_bytes):
                edge = True  # too much for one block: the group comes in blocks
                yield out(False)
            if held:
                for name, values in columns.items():
                    held[name].extend(values[at:end])
            else:
                held = {name: values[at:end] for name, values in columns.items()}
            rows, size = rows + end - at, size + each * (end - at)
    if rows:
        yield out(False)


def typed(rows: DataFrame, *columns: str, ddl: str = "") -> T.StructType:
    """Columns of ``rows`` as they are, and those of ``ddl``."""
    fields = [rows.schema[c] for c in columns]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields] + T.StructType.fromDDL(ddl or "").fields)


def _weight(value: object) -> int:
    if isinstance(value, (str, bytes)):
        return len(value)
    return sum(map(_weight, value)) if isinstance(value, list) else 8


def in_batches(
    rows: Iterable[tuple], schema: T.StructType, most_rows: int = 1_000, most_bytes: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches."""
    arrow, held, size = to_arrow_schema(schema), [], 0

    def made() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], arrow.names)

    for row in rows:
        held.append(row)
        size += sum(map(_weight, row))
        if len(held) >= most_rows or size >= most_bytes:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def scanned(blocks: DataFrame, step: Callable, ddl: str, last_first: bool = False) -> DataFrame:
    """The blocks of each ``conv_id`` in their order, or against it, one at a time through
    ``step(row, carried)``: its first value is put out with the place of the block, its
    second is handed to the next block. Blocks should be thin here."""
    order = [F.col(c).desc() if last_first else F.col(c) for c in ("part", "block")]
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    schema = typed(blocks, "conv_id", "part", "block", ddl=ddl)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        whose, carried = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if whose != (key := (row["conv_id"],)):
                    whose, carried = key, None
                values, carried = step(row, carried)
                yield row["conv_id"], row["part"], row["block"], *values

    return ordered.mapInArrow(lambda batches: in_batches(scan(batches), schema), schema)
