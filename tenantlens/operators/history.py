"""History kept by insert-only merge, and the moving window re-read each run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.operators.key_index import KeyIndex
from tenantlens.operators.joins import (
    BROADCAST_BYTES,
    common_types,
    holds_unordered,
    stored_bytes,
    without_match,
)
from tenantlens.schemas import ACTIVITY_WINDOW_DAYS, CAPACITY_WINDOW_DAYS
from tenantlens.sources.tables import TableStore

ACTIVITY_KEYS = ("Id",)
# The hour of one capacity. Without the capacity a second one would lose its hours.
CAPACITY_KEYS = ("capacity_id", "date", "start_of_hour")


def _missing_key(keys: Sequence[str]) -> Column:
    condition = F.lit(False)
    for key in keys:
        condition = condition | F.col(key).isNull()
    return condition


def new_rows(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    **hot_key_options: int,
) -> DataFrame:
    """Batch rows whose key the target lacks. A row with a missing key part
    equals nothing and is always new.

    Only the key columns of the target are read. If the counted size of the
    batch keys is within ``broadcast_bytes``, they are sent to the target, and
    the distinct keys found there, no more than were sent, are sent back:
    neither the history nor the batch is shuffled. If not, both are shuffled by
    key, with hot and missing keys of the batch kept apart.
    """
    keys = list(keys)
    common = common_types(batch, target, keys)
    batch_keys = batch.select(*keys)
    if stored_bytes(batch_keys) > broadcast_bytes:
        return without_match(batch, target, keys, **hot_key_options)
    typed = [F.col(f"`{k}`").cast(t).alias(k) for k, t in common.items()]
    sent = F.broadcast(batch.select(*typed).distinct())
    found = target.select(*typed).join(sent, keys, "left_semi").distinct()
    return batch.join(F.broadcast(found), keys, "left_anti").select(*batch.columns)


def _unknown_rows(
    batch: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    **hot_key_options: int,
) -> DataFrame:
    """Batch rows whose key is not among ``known`` ones of the batch."""
    if stored_bytes(known) > broadcast_bytes:
        return without_match(batch, known, list(keys), **hot_key_options)
    return batch.join(F.broadcast(known), list(keys), "left_anti").select(*batch.columns)


def one_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Copies of a key inside one batch merged to the smallest row; rows with a
    missing key part all stay. Copies meet pre-merged, one per task. Columns that have
    no order, such as the whole record, are compared as JSON text."""
    missing = _missing_key(keys)
    kept = _smallest_per_key(batch.where(~missing), keys)
    return kept.unionByName(batch.where(missing))


def _without_copies(batch: DataFrame, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``one_per_key`` of a stored batch. The keys are counted first: few of a batch come
    more than once, and only the rows of those are moved and compared whole."""
    keys = list(keys)
    counted = batch.where(~_missing_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counted.where("_n > 1").select(*keys)
    size = stored_bytes(repeated)
    if not size:
        return batch
    if size > broadcast_bytes:
        return one_per_key(batch, keys)
    sent = F.broadcast(repeated)
    once = batch.join(sent, keys, "left_anti").select(*batch.columns)
    copies = batch.join(sent, keys, "left_semi").select(*batch.columns)
    return once.unionByName(_smallest_per_key(copies, keys))


def _smallest_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    loose = [f.name for f in batch.schema.fields if holds_unordered(f.dataType)]
    if loose:
        ordered = [F.col(f"`{c}`") for c in batch.columns if c not in loose]
        smallest = F.min_by(row, F.struct(*ordered, F.to_json(F.struct(*[F.col(f"`{c}`") for c in loose]))))
    else:
        smallest = F.min(row)
    return batch.groupBy(*keys).agg(smallest.alias("_row")).select("_row.*")


def merge_insert_only(
    store: TableStore,
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    *,
    merge_copies: bool = False,
    partition_by: Sequence[str] = (),
    held: bool = False,
    index: KeyIndex | None = None,
    **join_options: int,
) -> int:
    """Append the batch rows whose key is not in the table yet; never change a
    row. The first load creates the table. Returns the rows added. ``held`` says that
    the caller keeps the batch, so that it is not stored here once more. ``index``
    tells which keys are there already, and is brought up to date.

    Rows are only added, and those that are there are found again, so a run
    that broke off is repaired by running it once more. Rows without a key
    cannot be found again: every run adds them.
    """
    loaded = store.exists(name)
    if not held and (loaded or merge_copies):
        # read several times below, and parsed from its files only once
        batch = batch.persist(StorageLevel.DISK_ONLY)
    try:
        rows = _without_copies(batch, keys) if merge_copies else batch
        if loaded and index is not None and index.takes(batch):
            state = index.ready()
            rows = _unknown_rows(rows, index.known(batch, state), keys, **join_options)
            added = store.append(name, rows, partition_by)["rows"]
            index.added(state)
            return added
        if loaded:
            rows = new_rows(rows, store.read(name), keys, **join_options)
        return store.append(name, rows, partition_by)["rows"]
    finally:
        if index is not None:
            index.release()
        if not held:
            batch.unpersist()


def window_bounds(
    today: dt.date, days: int, include_today: bool
) -> tuple[dt.datetime, dt.datetime]:
    """Start and end (exclusive) of a window of whole days."""
    last = today if include_today else today - dt.timedelta(days=1)
    first = last - dt.timedelta(days=days - 1)
    at_midnight = dt.time()
    return (
        dt.datetime.combine(first, at_midnight),
        dt.datetime.combine(last + dt.timedelta(days=1), at_midnight),
    )


def in_window(ts: Column, bounds: tuple[dt.datetime, dt.datetime]) -> Column:
    """Half-open comparison on the bare column, so that it reaches the scan."""
    start, end = (F.lit(b.isoformat(sep=" ")).cast("timestamp_ntz") for b in bounds)
    return (ts >= start) & (ts < end)


def activity_window(today: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """The days the audit log still holds, today included."""
    return window_bounds(today, ACTIVITY_WINDOW_DAYS, include_today=True)


def capacity_window(today: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """The last complete days of capacity use; today is not complete."""
    return window_bounds(today, CAPACITY_WINDOW_DAYS, include_today=False)
