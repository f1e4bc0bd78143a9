r"""Exact top-k search by inner product with pivot-table elimination.

Vectors become integers, ``floor(scale * x)`` of each component. Every vector's
distances to ``PIVOTS`` pivots are computed once and kept beside it. As
``q . c = (|q|^2 + |c|^2 - |q - c|^2) / 2`` and no pivot p lets ``|q - c|`` be
less than ``|d(q, p) - d(c, p)|``, the largest of these differences bounds a
candidate's score from above. In each block a query evaluates candidates in the order
of their bounds, a chunk at a time, and stops where the next bound cannot reach its k-th
score; ties are evaluated, so the result is exact. Blocks are searched each for itself:
no score passes from one to another.

Scale: the stated queries meet all rows in blocks. Candidate blocks are dealt out once, as
are query blocks, and each pair of blocks is one row of a product of the two: a task has
one part of each, holds at most about ``QUERY_BLOCKS`` query blocks and reads its candidate
blocks one by one. Nothing is copied for other tasks and no block passes through the
driver. A task returns k rows per query and block, which a ranking with partial limits
reduces. Pivots are a fixed number per vector length, of at most ``LENGTHS`` lengths; other
vectors are evaluated plainly. There are as many parts as candidate blocks, up to
``GROUPS``: beyond, a task has several blocks.

Defined cases: vectors that are null or hold a null or non-finite component, or
have no id, take no part; vectors are compared with those of their own length
(an empty one scores 0); of a query's rows all with its id are left out; repeated
candidates count each; ties go to the smaller id; scores beyond 64 bits are the
nearest 64-bit number; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenantlens.llm.common import stored

PIVOTS = 32
LENGTHS = 64
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 512
GROUPS = 512  # parts of the candidates at most
QUERY_BLOCKS = 64  # in a part of the queries
FIRST = 128  # candidates of the first chunk; later ones are twice as large each
EXACT = 2**53
LIMIT = 2**63 - 1
BLOCK = "width int, block long, ids binary, keys binary, vectors binary, wide boolean, distances binary"


def usable(column: str) -> Column:
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return x.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integers(vectors: list, scale: int) -> np.ndarray:
    """floor(scale * x); Python integers where 64-bit floats would not hold them."""
    x = np.floor(np.array(vectors, np.float64).reshape(len(vectors), -1) * scale)
    if x.size and not np.abs(x).max() < 2**31:
        return np.array([[int(v) if np.isfinite(v) else int(LIMIT * np.sign(v)) for v in row] for row in x], object)
    return x.astype(np.int64)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of one query with candidates."""
    if queries.dtype == object or candidates.dtype == object:
        return np.array([min(max(sum(int(a) * int(b) for a, b in zip(queries, c, strict=True)), -LIMIT - 1), LIMIT) for c in candidates], object)
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * max(1, len(queries))
    if most < EXACT:
        return (candidates.astype(np.float64) @ queries.astype(np.float64)).astype(np.int64)
    if most < LIMIT:
        return candidates @ queries
    return products(queries.astype(object), candidates.astype(object))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of each vector to each pivot."""
    if vectors.dtype == object or not len(pivots):
        return np.zeros((len(vectors), 0))
    return np.sqrt(((vectors[:, None, :] - pivots[None, :, :]).astype(np.float64) ** 2).sum(axis=2))


def pack(vectors: np.ndarray) -> tuple[bytes, bool]:
    if vectors.dtype == object:
        return b"\n".join(b",".join(str(v).encode() for v in row) for row in vectors), True
    return vectors.astype("<i4").tobytes(), False


def unpack(data: bytes, rows: int, width: int, wide: bool) -> np.ndarray:
    if wide:
        lines = data.split(b"\n")
        return np.array([[int(v) for v in line.split(b",")] for line in lines], object).reshape(rows, width)
    return np.frombuffer(data, "<i4").reshape(rows, width).astype(np.int64)


def find_pivots(rows: DataFrame, scale: int) -> dict[int, np.ndarray]:
    """For each vector length its pivots, the vectors of the smallest hashes."""
    lengths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").limit(LENGTHS)
    common = [r["width"] for r in lengths.collect() if r["width"] > 0]
    place = F.row_number().over(Window.partitionBy(F.size("vector")).orderBy(F.xxhash64("vec_id"), "vec_id"))
    chosen = rows.filter(F.size("vector").isin(common)).withColumn("place", place).filter(F.col("place") <= PIVOTS)
    found: dict[int, list] = {}
    for row in chosen.select("vector").collect():  # PIVOTS of at most LENGTHS lengths
        found.setdefault(len(row["vector"]), []).append(row["vector"])
    made = {width: integers(own, scale) for width, own in found.items()}
    return {width: own for width, own in made.items() if own.dtype != object}


def blocks(rows: DataFrame, pivots, scale: int, size: int) -> DataFrame:
    """Packed vectors with their distances to the pivots; columns BLOCK."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(width: int, own: list) -> pa.RecordBatch:
            nonlocal count
            count += 1
            vectors = integers([o[2] for o in own], scale)
            data, wide = pack(vectors)
            far = distances(vectors, pivots.value.get(width, np.zeros((0, width), np.int64)))
            row = {
                "width": width,
                "block": (part << 32) + count,
                "ids": np.array([o[0] for o in own], "<i8").tobytes(),
                "keys": np.array([o[1] for o in own], "<i8").tobytes(),
                "vectors": data,
                "wide": wide,
                "distances": far.astype("<f8").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [("width", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("keys", pa.binary())]
            + [("vectors", pa.binary()), ("wide", pa.bool_()), ("distances", pa.binary())]
        )
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "key", "vector")), strict=True):
                own = held.setdefault(len(row[2]), [])
                own.append(row)
                if len(own) == size:
                    yield block(len(row[2]), held.pop(len(row[2])))
        for width, own in held.items():
            yield block(width, own)

    return rows.select("vec_id", F.xxhash64("vector").alias("key"), "vector").mapInArrow(make, BLOCK)


class Candidates:
    """A block's vectors with what all queries need of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, far: np.ndarray):
        self.ids, self.vectors, self.far = ids, vectors, far
        self.floats = vectors.astype(np.float64)
        self.norms = (self.floats**2).sum(axis=1)
        self.most = 0 if vectors.dtype == object else int(np.abs(vectors).max(initial=0))

    def scores(self, query: np.ndarray, chosen) -> np.ndarray:
        if query.dtype != object and self.vectors.dtype != object:
            if int(np.abs(query).max(initial=0)) * self.most * max(1, len(query)) < EXACT:
                return (self.floats[chosen] @ query.astype(np.float64)).astype(np.int64)
        return products(query, self.vectors[chosen])

    def best(self, query: np.ndarray, q_id: int, q_far: np.ndarray | None, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best, in the order of the bounds."""
        other = self.ids != q_id
        if q_far is None or len(self.ids) <= FIRST:
            return top(self.scores(query, other), self.ids[other], k)
        q_norm = float((query.astype(np.float64) ** 2).sum())
        low = np.abs(self.far - q_far).max(axis=1)
        bound = (q_norm + self.norms - low * low) / 2
        bound += 1 + 1e-9 * (q_norm + self.norms)  # rounding
        bound[~other] = -np.inf
        chosen = np.argpartition(-bound, FIRST)[:FIRST]
        chosen = chosen[other[chosen]]
        kept = top(self.scores(query, chosen), self.ids[chosen], k)
        bound[chosen] = -np.inf
        left = np.flatnonzero(bound >= (kept[-1][0] if len(kept) == k else np.finfo(float).min))
        left, at, size = left[np.argsort(-bound[left])], 0, FIRST
        while at < len(left) and (len(kept) < k or bound[left[at]] >= kept[-1][0]):
            chosen, at, size = left[at : at + size], at + size, 2 * size
            kept = sorted(kept + top(self.scores(query, chosen), self.ids[chosen], k), key=lambda x: (-x[0], x[1]))[:k]
        return kept


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k highest scores, ties to the smaller id."""
    if scores.dtype != object and len(scores) > k:
        reach = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[reach], ids[reach]
    return sorted(zip((int(s) for s in scores), ids.tolist(), strict=True), key=lambda x: (-x[0], x[1]))[:k]


def searched(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, key, vec_id, score: the k best of each pair of blocks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(row: dict, mark: str):
            ids = np.frombuffer(row[mark + "ids"], "<i8")
            vectors = unpack(row[mark + "vectors"], len(ids), row["width"], row[mark + "wide"])
            return ids, vectors, np.frombuffer(row[mark + "distances"], "<f8").reshape(len(ids), -1)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q_ids, q_vectors, q_far = side(row, "q_")
                block = Candidates(*side(row, ""))
                pruned = q_far.shape[1] == block.far.shape[1] > 0
                out = []
                for j, (q_id, key) in enumerate(zip(q_ids.tolist(), np.frombuffer(row["q_keys"], "<i8").tolist(), strict=True)):
                    for score, c in block.best(q_vectors[j], q_id, q_far[j] if pruned else None, k):
                        out.append((q_id, key, c, score))
                columns = list(zip(*out, strict=True)) or [()] * 4
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["query_id", "key", "vec_id", "score"])

    own = candidates.drop("block", "keys").repartition(min(GROUPS, max(1, candidates.count())))
    marked = queries.select("width", *(F.col(c).alias("q_" + c) for c in ("ids", "keys", "vectors", "wide", "distances")))
    marked = marked.repartition(max(1, -(-queries.count() // QUERY_BLOCKS)))
    # never by broadcast: the driver would collect a side, whose size is only estimated
    pairs = own.join(marked.hint("shuffle_replicate_nl"), "width")
    return pairs.mapInArrow(search, "query_id long, key long, vec_id long, score long")


def top_k(
    table: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows where ``is_query`` holds."""
    rows = table.filter(usable(vector) & F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks"))
    pivots = table.sparkSession.sparkContext.broadcast(find_pivots(rows, scale))
    candidates = stored(blocks(rows, pivots, scale, BLOCK_ROWS), "vector-blocks")
    asked = rows.filter("asks").dropDuplicates(["vec_id", "vector"])
    queries = stored(blocks(asked, pivots, scale, BLOCK_QUERIES), "query-blocks")
    found = searched(queries, candidates, k)
    place = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
