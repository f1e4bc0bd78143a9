"""Helpers shared by the operators: scratch tables, words, hashes, ranges."""

from __future__ import annotations

import contextlib
import ctypes
import os
import pathlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantlens.session import scratch_dir

WHITE = " \t\n\x0b\f\r"  # [\x20\x09-\x0D]
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = 0x9E3779B97F4A7C15
CACHED_WORDS = 200_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20  # about 2,000 texts, as many as a slice holds


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package where the driver found it on its own path.

    A cluster brings the package along by ``--py-files`` or installs it.

    Also bounds the batches that workers get: by rows alone, 10,000 texts lie in the
    executor's direct memory and in the worker at once, of which a slice is looked at.
    """
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES)) > MOST_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))
    root = str(pathlib.Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in (path := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [path, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: bytes | None) -> list[bytes]:
    r"""Runs of ``[^\x20\x09-\x0D]``; ``bytes.split`` separates at just those."""
    return text.split() if text else []


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, of about ``rows`` rows each, for work that keeps much more than the
    text of each row. The parts of a batch are of one size, so that none is a small rest.

    A Python worker serves many tasks: what a task leaves unused goes back to the system.
    """
    for batch in batches:
        step = -(-batch.num_rows // max(1, round(batch.num_rows / rows)))
        for at in range(0, batch.num_rows, step or 1):
            yield batch.slice(at, step)
    give_back()


def give_back() -> None:
    """At a task's end: memory that is free in the worker goes back to the system, which
    a worker without a task would keep otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # the C library of Linux has it
        ctypes.CDLL(None).malloc_trim(0)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of a word, kept for the first ``CACHED_WORDS`` words met."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, by Horner's rule on the word hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    if n <= 8:
        out = words[:count].copy()
        for i in range(1, n):
            out = out * np.uint64(BASE) + words[i : i + count]
        return mixed(out)
    # doubling: a run of n words is two overlapping runs of a power of two
    width, out = 1, words
    while width * 2 <= n:
        size = len(out) - width
        out = mixed(out[:size] * np.uint64(BASE) + out[width : width + size])
        width *= 2
    if width < n:
        out = mixed(out[:count] * np.uint64(BASE) + out[n - width : n - width + count])
    return out[:count]


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words; a shorter text is one run."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, min(n, len(words))))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def identified(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Only the columns named: others, whatever their names, take no part."""
    return docs.select(*[F.col(c) for c in columns])


FILTER_BITS = 1 << 25  # of a Bloom filter: 4 MB, whatever the number of keys


def _filter_positions(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    x = mixed(one.view(np.uint64) * np.uint64(BASE) + two.view(np.uint64))
    return [(x >> np.uint64(shift)) % np.uint64(FILTER_BITS) for shift in (0, 13, 26, 39)]


def likely_in(rows: DataFrame, keys: DataFrame, columns: tuple[str, str]) -> DataFrame:
    """The rows whose two long key columns may be among ``keys``: all that are, and few others.

    Goes before a join on these columns, so that rows without a partner are not
    shuffled. The filter has a fixed size: with very many keys it lets more rows
    through, and the join after it is right in any case.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_filter_positions(*(batch.column(c).to_numpy() for c in columns))))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            ones = np.uint64(1) << (at & np.uint64(63))
            value = np.bitwise_or.reduceat(ones, first) if len(at) else ones
            yield pa.record_batch([pa.array(word.astype(np.int64)), pa.array(signed(value))], ["word", "value"])

    found = keys.select(*columns).mapInArrow(bits, "word long, value long")
    words = found.groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()  # FILTER_BITS / 64 rows at most
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[words["word"].to_numpy()] = words["value"].to_numpy().view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for at in _filter_positions(*(batch.column(c).to_numpy() for c in columns)):
                ok &= (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
            yield batch.filter(pa.array(ok))
        give_back()

    return rows.mapInArrow(ask, rows.schema)
