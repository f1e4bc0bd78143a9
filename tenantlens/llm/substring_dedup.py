r"""Removal of long repeated passages by De Bruijn compaction.

Every run of ``window`` consecutive words is an edge between its first and its
last ``window - 1`` words. Edges are not shuffled one by one. Each is assigned to
its *anchor*, the run of ``seed`` words of the smallest hash in it, and
consecutive edges of a document with one anchor are written as one *path*: its
anchor, a digest of its words and its source coordinates. Equal words have equal
anchors, so all copies of an edge meet under one anchor:

1. Anchors met in one document only hold no repeated edge and leave.
2. Paths of the same anchor and digest are compacted to one by a grouping; a
   document that is not the first with a path loses the whole of it.
3. An anchor with several digests is where the graph branches. The first
   document of each of its paths is read again at the path's coordinates, the
   path is split into its edges, and each edge is verified against the others by
   a 128-bit digest of its words.
4. Ranges are merged in each document by their coordinates.

Scale: one row per about ``(window - seed + 2) / 2`` words is shuffled, with
anchors counted after a partial count; a passage that a third of the documents
hold is compacted in the tasks that read it. Joins are plain equi-joins, which
adaptive execution splits where a key is hot. A document's ranges, bounded by its
own length, are the only thing gathered.

Defined cases: words are ``[^\x20\x09-\x0D]+``; a null text has none. Edges are
judged on the input. Documents of the same ``doc_id`` do not take words from each
other; documents without an id come after all others, by a hash of their text.
Ids are below 2^62. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import WordHashes, gram_hashes, signed, stored, texts, words_of

SEED = 12
PATHS = "rank long, text_key long, anchor long, content long, start int, edges int"
NO_ID = 2**62  # ranks from here on belong to documents without an id


def rank() -> Column:
    """The id; documents without one come after all others, by a hash of their text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64("text"), 2))


def identity(docs: DataFrame) -> DataFrame:
    """doc_id, text and what tells rows apart: rank, text_key."""
    return docs.select("doc_id", "text", rank().alias("rank"), F.xxhash64("text").alias("text_key"))


class Words:
    """The words of a text, their bytes joined by one space, and where each begins."""

    def __init__(self, text: bytes | None):
        self.words = words_of(text)
        self.joined = b" ".join(self.words)
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1
        self.begins = np.concatenate([[0], np.cumsum(sizes)])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> Iterator[memoryview]:
        """Bytes of the words from start to before end."""
        view = memoryview(self.joined)
        for a, b in zip(self.begins[starts].tolist(), (self.begins[ends] - 1).tolist(), strict=True):
            yield view[a:b]


def document_paths(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first edge and number of edges of each path of a document."""
    grams = gram_hashes(hashes, seed)
    edges = len(hashes) - window + 1
    anchors = np.arange(edges) + np.lib.stride_tricks.sliding_window_view(grams, window - seed + 1).argmin(axis=1)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1])
    return grams[anchors[starts]], starts, np.diff(np.append(starts, edges))


def paths(docs: DataFrame, window: int, seed: int = SEED) -> DataFrame:
    """One row per path; columns PATHS."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ranks, keys = (batch.column(c).to_pylist() for c in ("rank", "text_key"))
            found = []
            for text, *ids in zip(texts(batch), ranks, keys, strict=True):
                source = Words(text)
                if len(source.words) < window:
                    continue
                anchor, start, edges = document_paths(known.of(source.words), window, seed)
                content = [xxhash.xxh3_64_intdigest(x) for x in source.slices(start, start + edges + window - 1)]
                n = len(start)
                found.append((*(np.full(n, i) for i in ids), signed(anchor), signed(np.array(content, np.uint64)), start, edges))
            for at in range(0, len(found), 512):
                columns = [np.concatenate(c) for c in zip(*found[at : at + 512], strict=True)]
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                yield pa.record_batch(
                    [pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)],
                    ["rank", "text_key", "anchor", "content", "start", "edges"],
                )

    return docs.select("text", "rank", "text_key").mapInArrow(find, PATHS)


def split_edges(docs: DataFrame, branching: DataFrame, window: int) -> DataFrame:
    """rank, text_key, start, w1, w2: the edges of these paths, digested at their source."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, keys, all_paths = (batch.column(c).to_pylist() for c in ("rank", "text_key", "paths"))
            for text, doc, key, own in zip(texts(batch), ranks, keys, all_paths, strict=True):
                source = Words(text)
                start = np.unique(np.concatenate([np.arange(p["start"], p["start"] + p["edges"]) for p in own]))
                marks = b"".join(xxhash.xxh3_128_digest(x) for x in source.slices(start, start + window))
                marks = np.frombuffer(marks, "<i8").reshape(-1, 2)
                n = len(start)
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, doc)),
                        pa.array(np.full(n, key)),
                        pa.array(start).cast(pa.int32()),
                        pa.array(marks[:, 0]),
                        pa.array(marks[:, 1]),
                    ],
                    ["rank", "text_key", "start", "w1", "w2"],
                )

    own = branching.groupBy("rank", "text_key").agg(F.collect_set(F.struct("start", "edges")).alias("paths"))
    return (
        docs.select("text", "rank", "text_key")
        .join(own, ["rank", "text_key"])
        .mapInArrow(split, "rank long, text_key long, start int, w1 long, w2 long")
    )


def repeated_ranges(docs: DataFrame, window: int, seed: int = SEED) -> DataFrame:
    """rank, text_key, start, stop: runs of words that a document of smaller rank has as well."""
    # lists of anchors and digests are written before they are joined: a join of plain
    # scans is one that adaptive execution can split where a passage is hot
    found = stored(paths(docs, window, seed), "paths")
    ends = found.groupBy("anchor").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
    shared = stored(ends.filter("low < high").select("anchor"), "shared-anchors")
    repeated = stored(found.join(shared, "anchor"), "shared-paths")
    compact = stored(repeated.groupBy("anchor", "content").agg(F.min("rank").alias("first")), "compact-paths")
    ends = compact.groupBy("anchor").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    branches = stored(ends.filter("a <> b").select("anchor"), "branching-anchors")
    judged = repeated.join(compact, ["anchor", "content"])
    whole = judged.filter("rank > first").select(
        "rank", "text_key", "start", (F.col("start") + F.col("edges") + (window - 1)).alias("stop")
    )
    branching = judged.filter("rank = first").join(branches, "anchor")
    edges = stored(split_edges(docs, branching, window), "branching-edges")
    ends = edges.groupBy("w1", "w2").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    earliest = stored(ends.filter("first < last").select("w1", "w2", "first"), "shared-edges")
    late = edges.join(earliest, ["w1", "w2"]).filter("rank > first")
    return whole.unionByName(late.select("rank", "text_key", "start", (F.col("start") + window).alias("stop")))


def remove_repeats(docs: DataFrame, window: int = 50, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, and the removed spans as pairs of word positions."""
    docs = identity(docs)
    ranges = repeated_ranges(docs, window, seed).groupBy("rank", "text_key")
    ranges = ranges.agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept, spans = [], [], [], []
            for text, found in zip(texts(batch), batch.column("ranges").to_pylist(), strict=True):
                words = words_of(text)
                merged: list[list[int]] = []
                for start, stop in sorted((r["start"], r["stop"]) for r in found or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(stop, merged[-1][1])
                    else:
                        merged.append([start, stop])
                total.append(len(words))
                removed.append(sum(b - a for a, b in merged))
                for a, b in reversed(merged):
                    del words[a:b]
                kept.append(b" ".join(words))
                spans.append(merged)
            yield pa.record_batch(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "removed_spans"],
            )

    joined = docs.join(ranges, ["rank", "text_key"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(
        keep, "doc_id long, n_words long, n_removed long, kept_text string, removed_spans array<array<int>>"
    )
