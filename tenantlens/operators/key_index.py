"""Index of the keys of a history, so that a merge need not read them all.

Three tables beside the history, all made by Spark and readable by it:

* ``keys``: every key with its 64-bit hash, in buckets of hashes, sorted by hash;
* ``filter``: a blocked Bloom filter for each bucket: a key sets four bits in one word,
  so one look-up of a word answers for a key. Appends add words of their own; a key's
  bits were all set by one append, so words are not merged to be asked;
* ``state``: buckets, and a digest of the data files the index stands for.

A batch is first compared with the keys of its own days (an extraction brings the days
of its window again), then what is left asks the filter (about three bytes a key of the
history). For the few keys that it does not rule out, the hashes of their buckets are
read, and only for hashes found there the keys themselves: the answer is exact. An index
whose digest differs from the files of the table, because it is lost, behind or broken
off, is made again from the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.operators.joins import BROADCAST_BYTES, stored_bytes
from tenantlens.sources.tables import TableStore

BUCKET_KEYS = 1_000_000
BITS_PER_KEY = 16
INCOMPLETE = -1  # bucket of keys with a missing part: these equal nothing


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


class KeyIndex:
    """Index of one table's keys. ``near`` is the partition column of the days that a
    batch is compared with first; ``bucket_keys`` is the size a bucket is made for."""

    def __init__(
        self,
        store: TableStore,
        name: str,
        keys: Sequence[str],
        *,
        near: str | None = None,
        bucket_keys: int = BUCKET_KEYS,
        broadcast_bytes: int = BROADCAST_BYTES,
    ):
        self.store, self.index, self.name, self.keys = store, store.index, name, list(keys)
        self.near, self._held, self._names = near, [], frozenset()
        self.bucket_keys, self.broadcast_bytes = bucket_keys, broadcast_bytes
        self.words = max(1, bucket_keys * BITS_PER_KEY // 64)

    def _part(self, part: str) -> str:
        return f"{self.name}.{part}"

    def _files(self) -> str:
        """Digest of the names of the table's data files; a written file never changes."""
        self._names = frozenset(self.store.read(self.name).inputFiles())
        return hashlib.sha256("\n".join(sorted(self._names)).encode()).hexdigest()

    def _hashed(self, rows: DataFrame, buckets: int) -> DataFrame:
        """Keys with their hash, bucket, word of the filter and bits in it."""
        columns = [F.col(f"`{k}`") for k in self.keys]
        mark = F.xxhash64(F.lit("filter"), *columns)
        places = [F.pmod(F.shiftrightunsigned(mark, 6 * i), F.lit(64)).cast("int") for i in range(4)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
        word = F.pmod(F.shiftrightunsigned(mark, 24), F.lit(self.words)).cast("int")
        hashed = rows.select(
            *columns,
            F.when(_complete(self.keys), F.xxhash64(*columns)).alias("key_hash"),
            word.alias("word"),
            reduce(lambda a, b: a.bitwiseOR(b), bits).alias("mask"),
        )
        bucket = F.coalesce(F.pmod("key_hash", F.lit(buckets)), F.lit(INCOMPLETE))
        return hashed.withColumn("bucket", bucket.cast("int"))

    def _state(self) -> dict | None:
        """Buckets and rows of an index that stands for the table as it is."""
        if not self.index.exists(self._part("state")):
            return None
        state = self.index.read(self._part("state")).first()
        return state.asDict() if state and state["files"] == self._files() else None

    def _write(self, hashed: DataFrame, add: bool) -> None:
        laid = hashed.select("key_hash", *self.keys, "bucket").repartition("bucket").sortWithinPartitions("bucket", "key_hash")
        words = hashed.where(F.col("bucket") != INCOMPLETE).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        for part, rows in (("keys", laid), ("filter", words)):
            write = self.index.append_as_is if add else self.index.overwrite
            write(self._part(part), rows, ["bucket"])

    def _stands(self, buckets: int, rows: int, files: str) -> None:
        """Written last: what broke off before has the digest of an older state."""
        state = [(buckets, rows, files)]
        frame = self.store.spark.createDataFrame(state, "buckets BIGINT, rows BIGINT, files STRING")
        self.index.overwrite(self._part("state"), frame)

    def build(self) -> dict:
        """The index of all keys of the table."""
        files = self._files()
        keys = self.store.read(self.name).select(*[F.col(f"`{k}`") for k in self.keys])
        rows = keys.count()
        buckets = max(1, -(-rows // self.bucket_keys))
        self._write(self._hashed(keys, buckets), add=False)
        self._stands(buckets, rows, files)
        return {"buckets": buckets, "rows": rows, "files": files}

    def ready(self) -> dict:
        """State of the index, made again if it does not stand for the table. One that has
        outgrown its buckets twice is made again too."""
        state = self._state()
        if state and state["rows"] <= 2 * state["buckets"] * self.bucket_keys:
            return state
        return self.build()

    def added(self, state: dict) -> None:
        """After an append to the table that had ``state``: the keys of its new files."""
        before = self._names
        files = self._files()
        new = sorted(self._names - before)
        if not new:
            return
        reader = self.store.spark.read.option("basePath", self.store.path(self.name))
        keys = reader.schema(self.store.read(self.name).schema).parquet(*new).select(*[F.col(f"`{k}`") for k in self.keys])
        hashed = self._kept(self._hashed(keys, state["buckets"]))
        self._write(hashed, add=True)
        self._stands(state["buckets"], state["rows"] + hashed.count(), files)

    def takes(self, batch: DataFrame) -> bool:
        """Whether the batch's keys have the types of the table: only then hashes compare."""
        target = self.store.read(self.name)
        return all(batch.schema[k].dataType == target.schema[k].dataType for k in self.keys)

    def known(self, batch: DataFrame, state: dict) -> DataFrame:
        """The distinct keys of the batch that the table has. Call ``release`` when done."""
        keys = self.keys
        columns = [F.col(f"`{k}`") for k in keys]
        asked = batch.where(_complete(keys)).select(*columns).distinct()
        asked = self._kept(self._hashed(asked, state["buckets"]))
        small = stored_bytes(asked) <= self.broadcast_bytes
        found = []
        if self.near:
            days = [r[0] for r in batch.select(self.near).distinct().collect()]  # of one extraction
            day = F.col(self.near)
            there = self.store.read(self.name).where(day.isin([d for d in days if d is not None]) | day.isNull())
            found.append(self._kept(_matching(there.select(*columns), asked.select(*columns), keys, small)))
            asked = self._kept(asked.join(F.broadcast(found[0]) if small else found[0], keys, "left_anti"))
        hit = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
        words = self.index.read(self._part("filter"))
        maybe = words.join(F.broadcast(asked) if small else asked, ["bucket", "word"]).where(hit)
        maybe = self._kept(maybe.select("bucket", "key_hash", *columns).distinct())
        hashes = self._in_buckets(maybe, ["bucket", "key_hash"], small)
        sure = self._kept(maybe.join(F.broadcast(hashes) if small else hashes, ["bucket", "key_hash"], "left_semi"))
        found.append(self._in_buckets(sure, ["bucket", "key_hash", *keys], small).select(*columns))
        return reduce(DataFrame.unionByName, found)

    def _in_buckets(self, wanted: DataFrame, columns: list[str], small: bool) -> DataFrame:
        """Distinct rows of the key table that ``wanted`` names, from its buckets alone."""
        buckets = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]  # as many as buckets
        rows = self.index.read(self._part("keys")).where(F.col("bucket").isin(buckets))
        return _matching(rows.select(*columns), wanted.select(*columns), columns, small)

    def _kept(self, rows: DataFrame) -> DataFrame:
        self._held.append(rows.persist(StorageLevel.DISK_ONLY))
        return rows

    def release(self) -> None:
        while self._held:
            self._held.pop().unpersist()


def _matching(rows: DataFrame, wanted: DataFrame, columns: list[str], small: bool) -> DataFrame:
    return rows.join(F.broadcast(wanted) if small else wanted, columns, "left_semi").distinct()
