r"""Reversible line deduplication: exact reference counts behind sharded cuckoo filters.

A line's key is the line stripped of ``[\x20\x09-\x0D]`` with A-Z lower-cased,
held as a 128-bit digest. The *reference-count table* has one row per key with
the number of documents that hold it; adding documents adds to it and deleting
them subtracts, so every state can be reached again. The keys that reach the
threshold are mirrored in cuckoo filters, one per shard of keys, which also can
insert and delete. Documents ask the filters first; only what a filter answers
with "maybe" goes to the exact table.

Scale: keys are counted after a partial count in each task, so a line that a
third of the documents hold is one row per task. Filters hold ``SHARD_KEYS``
keys on average whatever the corpus. Key blocks of bounded size meet their
shard's filter in a plain join, which Spark may split; nothing is collected.

Defined cases: a null or empty text is one empty line; empty keys are never
dropped; rows with the same ``doc_id``, and rows without one, are documents of their
own; a line repeated in one document counts once; very long texts are read whole, a
slice of a batch at a time; an empty table gives an empty result; other columns take
no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import WHITE, sliced, stored, texts
from tenantlens.llm.substring_dedup import identity

STRIP = WHITE.encode()
SLOTS = 4  # of a bucket
SHARD_KEYS = 100_000
BLOCK_KEYS = 20_000
KICKS = 500
COUNTS = "k1 long, k2 long, refs long"
FILTERS = "shard int, buckets long, cells binary"


def key_of(line: bytes) -> bytes:
    return line.strip(STRIP).lower()  # bytes.lower() changes A-Z alone


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class CuckooFilter:
    """Partial-key cuckoo filter: 16-bit fingerprints, four slots a bucket.

    No key that was put in is ever missed; a deletion takes out one of the copies
    of its fingerprint and must be of a key that was put in.
    """

    def __init__(self, buckets: int, cells: np.ndarray | None = None):
        self.buckets = buckets
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else cells

    @classmethod
    def holding(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        """Filter with these keys, of the smallest power of two that takes them."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(k1)) / (SLOTS * 0.8)))))
        while True:
            built = cls(buckets)
            if built.insert(k1, k2):
                return built
            buckets *= 2

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(self.buckets - 1)
        prints = ((k2.view(np.uint64) >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        first = k2.view(np.uint64) & mask
        return prints, first, self.other(first, prints)

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        spread = prints.astype(np.uint64) * np.uint64(0x5BD1E995)
        return bucket ^ (spread & np.uint64(self.buckets - 1))

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False if a key found no place: the filter is then to be built anew, larger."""
        prints, first, second = self.places(k1, k2)
        cells, mask = self.cells.tolist(), self.buckets - 1
        for n, (mark, a, b) in enumerate(zip(prints.tolist(), first.tolist(), second.tolist(), strict=True)):
            for bucket in (a, b):
                if 0 in cells[bucket]:
                    cells[bucket][cells[bucket].index(0)] = mark
                    break
            else:
                bucket = b
                for kick in range(KICKS):
                    slot = (n + kick) % SLOTS
                    mark, cells[bucket][slot] = cells[bucket][slot], mark
                    bucket ^= (mark * 0x5BD1E995) & mask
                    if 0 in cells[bucket]:
                        cells[bucket][cells[bucket].index(0)] = mark
                        break
                else:
                    return False
        self.cells = np.array(cells, np.uint16).reshape(self.buckets, SLOTS)
        return True

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        prints, first, second = self.places(k1, k2)
        for mark, a, b in zip(prints.tolist(), first.tolist(), second.tolist(), strict=True):
            for bucket in (a, b):
                found = np.flatnonzero(self.cells[bucket] == mark)
                if len(found):
                    self.cells[bucket, found[0]] = 0
                    break

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(k1, k2)
        wanted = prints[:, None]
        hit = (self.cells[first.astype(np.int64)] == wanted).any(axis=1)
        return hit | (self.cells[second.astype(np.int64)] == wanted).any(axis=1)

    def row(self) -> tuple[int, bytes]:
        return self.buckets, self.cells.tobytes()

    @classmethod
    def of_row(cls, buckets: int, cells: bytes) -> CuckooFilter:
        return cls(buckets, np.frombuffer(cells, np.uint16).reshape(buckets, SLOTS).copy())


def document_keys(docs: DataFrame) -> DataFrame:
    """rank, text_key, keys: the distinct digests of a document's non-empty keys, joined."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [
                b"".join({digest(k) for line in (text or b"").split(b"\n") if (k := key_of(line))})
                for text in texts(batch)
            ]
            yield pa.record_batch(
                [batch.column("rank"), batch.column("text_key"), pa.array(found, pa.binary())],
                ["rank", "text_key", "keys"],
            )

    rows = identity(docs).select("rank", "text_key", "text")
    return rows.mapInArrow(keys, "rank long, text_key long, keys binary")


def reference_counts(keys: DataFrame) -> DataFrame:
    """k1, k2, refs: in how many documents each key lies."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<i8").reshape(-1, 2)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["k1", "k2"])

    rows = keys.select("keys").mapInArrow(each, "k1 long, k2 long")
    return rows.groupBy("k1", "k2").agg(F.count("*").alias("refs"))


def changed_counts(counts: DataFrame, added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """The table after documents came and went; keys without references leave it."""
    parts = [counts]
    if added is not None:
        parts.append(reference_counts(document_keys(added)))
    if removed is not None:
        gone = reference_counts(document_keys(removed))
        parts.append(gone.select("k1", "k2", (-F.col("refs")).alias("refs")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("k1", "k2").agg(F.sum("refs").alias("refs")).filter("refs > 0")


def shard_column(shards: int):
    return F.pmod(F.col("k1"), F.lit(shards)).cast("int").alias("shard")


def build_filters(counts: DataFrame, least_refs: int, shards: int) -> DataFrame:
    """A filter per shard with the keys of ``least_refs`` references or more."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.holding(rows["k1"].to_numpy(), rows["k2"].to_numpy()).row()
        return pd.DataFrame([(rows["shard"].iloc[0], *made)], columns=["shard", "buckets", "cells"])

    frequent = counts.filter(F.col("refs") >= least_refs)
    return frequent.select("k1", "k2", shard_column(shards)).groupBy("shard").applyInPandas(build, FILTERS)


def updated_filters(
    filters: DataFrame, before: DataFrame, after: DataFrame, least_refs: int, shards: int
) -> DataFrame:
    """Filters after a change of the counts: keys that crossed the threshold go in or out.
    A filter that has become full is built anew, larger, from the counts of its shard."""

    def update(key: tuple, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        into, out = changes[changes["enters"]], changes[~changes["enters"]]
        k1, k2 = into["k1"].to_numpy(), into["k2"].to_numpy()
        if old.empty:
            row = CuckooFilter.holding(k1, k2).row()
        else:
            made = CuckooFilter.of_row(int(old["buckets"].iloc[0]), old["cells"].iloc[0])
            made.delete(out["k1"].to_numpy(), out["k2"].to_numpy())
            row = made.row() if made.insert(k1, k2) else (0, None)  # full
        return pd.DataFrame([(key[0], *row)], columns=["shard", "buckets", "cells"])

    old, new = before.withColumnRenamed("refs", "was"), after.withColumnRenamed("refs", "now")
    held = F.coalesce("was", F.lit(0)) >= least_refs
    holds = F.coalesce("now", F.lit(0)) >= least_refs
    changes = (
        old.join(new, ["k1", "k2"], "full")
        .filter(held != holds)
        .select("k1", "k2", shard_column(shards), holds.alias("enters"))
    )
    updated = filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, FILTERS)
    updated = stored(updated, "line-filters")
    full = updated.filter("cells IS NULL").select("shard")
    whole = after.withColumn("shard", shard_column(shards)).join(full, "shard", "left_semi")
    return updated.filter("cells IS NOT NULL").unionByName(build_filters(whole.drop("shard"), least_refs, shards))


def maybe_frequent(keys: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """rank, text_key, k1, k2 of all keys that their shard's filter does not rule out."""
    block_type = np.dtype([(c, "<i8") for c in ("rank", "text_key", "k1", "k2")])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = batch.column("keys").to_pylist()
            pairs = np.frombuffer(b"".join(joined), "<i8").reshape(-1, 2)
            row = np.repeat(np.arange(len(joined)), [len(x) // 16 for x in joined])
            rows = np.empty(len(row), block_type)
            for c in ("rank", "text_key"):
                rows[c] = batch.column(c).to_numpy()[row]
            rows["k1"], rows["k2"] = pairs[:, 0], pairs[:, 1]
            shard = rows["k1"] % shards
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            parts = [
                part[i : i + BLOCK_KEYS]
                for part in np.split(order, cuts)
                for i in range(0, len(part), BLOCK_KEYS)
            ]
            yield pa.record_batch(
                [
                    pa.array([shard[p[0]] for p in parts], pa.int32()),
                    pa.array([rows[p].tobytes() for p in parts], pa.binary()),
                ],
                ["shard", "block"],
            )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, buckets, cells in zip(*(batch.column(c).to_pylist() for c in ("block", "buckets", "cells")), strict=True):
                rows = np.frombuffer(block, block_type)
                rows = rows[CuckooFilter.of_row(buckets, cells).contains(rows["k1"].copy(), rows["k2"].copy())]
                yield pa.record_batch([pa.array(rows[c]) for c in block_type.names], list(block_type.names))

    asked = keys.mapInArrow(blocks, "shard int, block binary")
    return asked.join(filters, "shard").mapInArrow(probe, "rank long, text_key long, k1 long, k2 long")


def drop_lines(docs: DataFrame, least_refs: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text: lines whose key lies in ``least_refs`` documents go."""
    keys = stored(document_keys(docs), "line-keys")
    counts = stored(reference_counts(keys), "line-refs")
    frequent = counts.filter(F.col("refs") >= least_refs)
    shards = max(1, frequent.count() // SHARD_KEYS)
    filters = stored(build_filters(counts, least_refs, shards), "line-filters")
    exact = maybe_frequent(keys, filters, shards).join(frequent, ["k1", "k2"], "left_semi")
    # of one text: rows of one id, or without one, do not share their keys, and copies repeat them
    dropped = exact.groupBy("rank", "text_key").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))
    joined = identity(docs).join(dropped, ["rank", "text_key"], "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out: tuple[list, ...] = ([], [], [])
            for text, gone in zip(texts(batch), batch.column("keys").to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                bad = {np.array([p["k1"], p["k2"]], "<i8").tobytes() for p in gone or ()}
                kept = [x for x in lines if not (k := key_of(x)) or digest(k) not in bad] if bad else lines
                for column, value in zip(out, (len(lines), len(lines) - len(kept), b"\n".join(kept)), strict=True):
                    column.append(value)
            yield pa.record_batch(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept_text"],
            )

    return joined.select("doc_id", "text", "keys").mapInArrow(
        keep, "doc_id long, n_lines long, n_dropped long, kept_text string"
    )


