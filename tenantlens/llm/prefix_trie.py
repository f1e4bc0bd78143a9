r"""Prefix trie of conversations in minimal-perfect-hash node tables.

*Digests.* Each turn is hashed (SHA-256 of role and text, 120 bits kept), each prefix
is a polynomial of its turns modulo 2^61-1 at two bases. A node is a distinct digest;
a conversation adds one entry to each node on its path. Parent, last turn and depth
must agree for all entries of a node, otherwise two prefixes have met in one digest
and the job stops.

*Shards.* A node whose members have more than ``most`` turns ahead of them is *big*.
What lies below the lowest big node of a path is a subtree of at most ``most`` entries,
and goes to one shard, whole. A node with one member has one leaf and nothing to save,
so shards hold shared nodes only.

*Node tables.* In a shard the digests get a minimal perfect hash (levels of bit arrays,
slots by rank). A look-up compares the digest stored in the slot, so a foreign digest
is told. Counts are scattered to flat arrays, the parents' digests become a
parent-slot array, and children are added to their parents' slots by depth, deepest
first: children, leaves, tokens saved. The roots of the shards are summed by parent,
and the big nodes are a last table of the same kind.

Scale: turns are shuffled without their texts, by ranges of conversations, so a long
conversation or family lies in several tasks as blocks; prefix digests are carried
over blocks as polynomials. Entries are counted in each task before they are shuffled;
hot prefixes are one row a task. Big nodes are counted before they are broadcast, and
``most`` grows fourfold while there are more than ``MOST_BIG`` of them (a prefix
shared over millions of turns). The ids of conversations that end in one node come as
packed blocks, in order, and stream through one task a node.

Defined cases: turns lie by turn (null first), then by digest of role and text; null
role or text is empty; rows without ``conv_id`` belong to no conversation and take no
part; equal rows are turns of their own; an empty table has no nodes; very long texts
count as any; other columns take no part.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenantlens.llm.common import mixed, sliced, stored
from tenantlens.llm.ordered import BLOCK_ROWS, dealt, in_batches, scanned, stretches, typed

PRIME = (1 << 61) - 1
BASES = (0x1D8AF066F2A5B3C7 % PRIME, 0x0B4E7C2D91F35A6B % PRIME)
MOST = 50_000  # entries below a node that is not big
MOST_BIG = 1_000_000
UNIT = 200_000  # nodes of a table, if its shards are small
TURN = np.dtype([("t1", "<i8"), ("t2", "<i8"), ("size", "<i8")])
DIGEST = np.dtype([("d1", "<i8"), ("d2", "<i8")])
NONE_SHA = hashlib.sha256(b"").hexdigest()

PIECE = "conv_id long, base long, part int, block int, whole boolean"
PATH = "at long, total long, digests binary, turns binary"
ENTRY = "d1 long, d2 long, p1 long, p2 long, tag long, depth long, conv_id long, size long, ahead long, is_end long"


def head_length(conv_id: int) -> int:
    """Turns that a rebuilt conversation takes from the first of its family."""
    return zlib.crc32(str(conv_id).encode()) % 9


MOST_HEAD = 8


def _turns(conversations: DataFrame, family: int) -> DataFrame:
    """One thin row a turn, in ranges of families: the first conversation before the others."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    known = F.col("conv_id").isNotNull()
    rows = conversations.filter(known).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat_ws("|", F.length(role), role, text), 256).alias("mark"),
        F.octet_length(text).cast("long").alias("size"),
    )
    bits = [F.conv(F.substring("mark", at, 15), 16, 10).cast("long") for at in (1, 16)]
    base = F.col("conv_id") - F.col("conv_id") % family
    thin = rows.select("conv_id", base.alias("base"), "turn", bits[0].alias("t1"), bits[1].alias("t2"), "size")
    return dealt(thin, "base", F.col("conv_id") != F.col("base"), "conv_id", "turn", "t1", "t2")


def _digests(turns: np.ndarray, start: tuple[int, int] = (0, 0)) -> np.ndarray:
    """Digest before each turn and after the last."""
    out = [start]
    for t1, t2, _ in turns.tolist():
        a, b = out[-1]
        out.append(((a * BASES[0] + t1) % PRIME, (b * BASES[1] + t2) % PRIME))
    return np.array(out, DIGEST)


def _pieces(turns: DataFrame, most_rows: int) -> DataFrame:
    """Rebuilt paths of conversations whose family a task has met whole, and pieces of others."""
    schema = typed(turns, ddl=f"{PIECE}, {PATH}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for family in stretches(batches, "base", most_rows):
            columns = family.columns
            rows = np.empty(len(columns["t1"]), TURN)
            for c in TURN.names:
                rows[c] = columns[c]
            ids = np.array(columns["conv_id"], np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            head = rows[:0]
            for a, b in itertools.pairwise(cuts):
                conv_id, own = int(ids[a]), rows[a:b]
                place = (conv_id, family.key, family.part, family.block, family.whole)
                if not family.whole:
                    yield *place, None, None, None, own.tobytes()
                    continue
                if conv_id == family.key:
                    head = own[:MOST_HEAD]
                h = head_length(conv_id)
                path = np.concatenate([head[:h], own[h:]])
                yield *place, 0, len(path), _digests(path).tobytes(), path.tobytes()

    return turns.mapInArrow(lambda batches: in_batches(cut(batches), schema), schema)


def _with_start(row: dict, carried: tuple | None) -> tuple[tuple, tuple]:
    """Depth and digest before a piece."""
    at, a, b = carried or (0, 0, 0)
    n = row["n"]
    behind = (
        at + n,
        (a * pow(BASES[0], n, PRIME) + row["h1"]) % PRIME,
        (b * pow(BASES[1], n, PRIME) + row["h2"]) % PRIME,
    )
    return (at, a, b), behind


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Paths, in pieces, of conversations whose family lies in several tasks."""
    place = ["conv_id", "part", "block"]
    n = (F.octet_length("turns") / TURN.itemsize).cast("long")
    running = Window.partitionBy("conv_id").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(*place, n.alias("n")).select(*place, F.coalesce(F.sum("n").over(running), F.lit(0)).alias("offset"))
    own = stored(pieces.select(*place, "base", "turns").join(offsets, place), "trie-own")
    first = own.filter(f"conv_id = base AND offset < {MOST_HEAD}")
    front = F.struct("offset", F.substring("turns", 1, MOST_HEAD * TURN.itemsize).alias("turns"))
    heads = first.groupBy("base").agg(F.collect_list(front).alias("head"))  # MOST_HEAD at most
    begun = own.filter("offset = 0").join(heads, "base", "left")
    later = own.filter("offset > 0").withColumn("head", F.lit(None).cast(heads.schema["head"].dataType))
    schema = typed(own, *place, "offset", ddl="n long, h1 long, h2 long, turns binary")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 64):
            for row in batch.to_pylist():
                mine = np.frombuffer(row["turns"], TURN)
                h = head_length(row["conv_id"])
                parts = sorted((p["offset"], p["turns"]) for p in row["head"] or ())
                head = np.frombuffer(b"".join(p for _, p in parts), TURN)[:MOST_HEAD][:h]
                path = np.concatenate([head, mine[max(0, h - row["offset"]) :]])
                h1, h2 = _digests(path)[-1].tolist()
                yield *[row[c] for c in place], row["offset"], len(path), h1, h2, path.tobytes()

    columns = [*place, "offset", "turns", "head"]
    whole = begun.select(*columns).unionByName(later.select(*columns))
    built = stored(whole.mapInArrow(lambda batches: in_batches(rebuild(batches), schema), schema), "trie-built")
    thin = built.select(*place, "n", "h1", "h2")
    starts = scanned(thin, _with_start, "at long, a long, b long")
    totals = thin.groupBy("conv_id").agg(F.sum("n").alias("total"))
    # totals are of conversations that several tasks share: as few as there are tasks
    placed = built.drop("h1", "h2").join(starts, place).join(totals, "conv_id")
    placed = placed.filter("n > 0 OR total = 0 AND offset = 0")  # one piece of a path without turns
    out = typed(built, *place, ddl=PATH)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 64):
            for row in batch.to_pylist():
                digests = _digests(np.frombuffer(row["turns"], TURN), (row["a"], row["b"]))
                yield *[row[c] for c in place], row["at"], row["total"], digests.tobytes(), row["turns"]

    return placed.mapInArrow(lambda batches: in_batches(digested(batches), out), out)


def paths(conversations: DataFrame, family: int = 5, most_rows: int = BLOCK_ROWS) -> DataFrame:
    """Paths of the rebuilt conversations: conv_id, part, block, whole, and of each piece
    the depth before it, the depth of the whole path, the digests and the turns."""
    pieces = stored(_pieces(_turns(conversations, family), most_rows), "trie-pieces")
    columns = ["conv_id", "part", "block", "whole", *[f.split()[0] for f in PATH.split(", ")]]
    spread = _joined_pieces(pieces.filter("NOT whole")).withColumn("whole", F.lit(False))
    return stored(pieces.filter("whole").select(*columns).unionByName(spread.select(*columns)), "trie-paths")


class Digests:
    """A sorted set of digests."""

    def __init__(self, d1: np.ndarray, d2: np.ndarray):
        order = np.lexsort((d2, d1))
        self.d1, self.d2 = d1[order], d2[order]

    def holds(self, digests: np.ndarray) -> np.ndarray:
        low, high = (np.searchsorted(self.d1, digests["d1"], side=s) for s in ("left", "right"))
        found = np.zeros(len(digests), bool)
        for step in range(int((high - low).max(initial=0))):
            at = np.minimum(low + step, len(self.d1) - 1)
            found |= (low + step < high) & (self.d2[at] == digests["d2"])
        return found


def _entries(pieces: DataFrame, big: Digests | None = None) -> DataFrame:
    """One row for each node on each path. With the big nodes, each row has its shard
    (s1, s2), null for big ones; ``s1, s2`` of a piece is the shard it begins in."""
    names = [f.split()[0] for f in ENTRY.split(", ")] + ["s1", "s2"] * (big is not None)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            made = [_entry_columns(row, big) for row in batch.to_pylist()]
            if made:
                columns = [np.concatenate(c) for c in zip(*made, strict=True)]
                arrays = [pa.array(c) for c in columns[: len(names)]]
                if big is not None:
                    arrays[-2:] = [pa.array(c, mask=columns[-1]) for c in columns[-3:-1]]
                yield pa.record_batch(arrays, names)

    ddl = ENTRY + ", s1 long, s2 long" * (big is not None)
    return pieces.mapInArrow(each, ddl)


def _entry_columns(row: dict, big: Digests | None) -> list[np.ndarray]:
    digests, turns = np.frombuffer(row["digests"], DIGEST), np.frombuffer(row["turns"], TURN)
    first = 0 if row["at"] == 0 else 1  # the root is an entry of the first piece
    n = len(digests)
    parents = np.concatenate([np.zeros(1, DIGEST), digests[:-1]])
    depth = row["at"] + np.arange(n, dtype=np.int64)
    tags = np.concatenate([[0], turns["t1"]]).astype(np.int64)
    sizes = np.concatenate([[0], turns["size"]]).astype(np.int64)
    columns = [
        digests["d1"],
        digests["d2"],
        parents["d1"],
        parents["d2"],
        tags,
        depth,
        np.full(n, row["conv_id"], np.int64),
        sizes,
        row["total"] - depth + 1,
        (depth == row["total"]).astype(np.int64),
    ]
    if big is not None:
        is_big = big.holds(digests)
        s1, s2 = (np.full(n, row.get(c) or 0, np.int64) for c in ("s1", "s2"))
        cut = int(is_big.sum())  # big nodes come first on a path
        if cut or row["at"] == 0:
            top = digests[min(cut, n - 1)]
            s1[cut:], s2[cut:] = top["d1"], top["d2"]
        columns += [s1, s2, is_big]
    return [c[first:] for c in columns]


def _begun_in(pieces: DataFrame, big: Digests) -> DataFrame:
    """Pieces of the paths with the shard that they begin in (0, 0 if they find their own)."""
    inner = pieces.filter("NOT whole")
    schema = typed(inner, "conv_id", "part", "block", ddl="c1 long, c2 long")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 64):
            for row in batch.to_pylist():
                digests = np.frombuffer(row["digests"], DIGEST)
                cut = int(big.holds(digests).sum())
                found = (cut or row["at"] == 0) and cut < len(digests)
                yield row["conv_id"], row["part"], row["block"], *(digests[cut].tolist() if found else (None, None))

    def carry(row: dict, carried: tuple | None) -> tuple[tuple, tuple | None]:
        behind = carried if row["c1"] is None else (row["c1"], row["c2"])
        return carried or (0, 0), behind

    cuts = inner.mapInArrow(lambda batches: in_batches(own(batches), schema), schema)
    begun = inner.join(scanned(cuts, carry, "s1 long, s2 long"), ["conv_id", "part", "block"])
    zero = F.lit(0).cast("long")
    return pieces.filter("whole").withColumns({"s1": zero, "s2": zero}).unionByName(begun)


def _big_nodes(pieces: DataFrame, most: int) -> Digests:
    """Shared nodes with more than ``most`` entries from them on."""
    total = pieces.agg(F.sum(F.octet_length("digests") / DIGEST.itemsize)).first()[0] or 0
    empty = np.empty(0, np.int64)
    if total <= most:
        return Digests(empty, empty)
    weighed = _entries(pieces).groupBy("d1", "d2").agg(F.sum("ahead").alias("ahead"), F.count("*").alias("n"))
    weighed = stored(weighed.filter((F.col("ahead") > most) & (F.col("n") > 1)), "trie-big")
    while (found := weighed.filter(F.col("ahead") > most)).count() > MOST_BIG:
        most *= 4
    rows = found.select("d1", "d2").toArrow()  # MOST_BIG at most
    return Digests(rows["d1"].to_numpy(), rows["d2"].to_numpy())


def _nodes(entries: DataFrame) -> DataFrame:
    """One row a node. Entries that do not agree stop the job."""

    def agreed(name: str):
        clash = F.raise_error(F.lit("two prefixes share a digest: choose other BASES")).cast("long")
        low, high = F.min(name), F.max(name)
        return F.when(low == high, low).otherwise(clash).alias(name)

    return entries.groupBy("d1", "d2").agg(
        *[agreed(c) for c in ("p1", "p2", "tag", "depth", "size")],
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.sum("is_end").alias("n_ends"),
        F.min("s1").alias("s1"),
        F.min("s2").alias("s2"),
    )


class SlotTable:
    """Minimal perfect hash of distinct digests: each level gives slots to those that
    are alone at their bit, by rank, and hands the others down."""

    def __init__(self, d1: np.ndarray, d2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, given = np.arange(len(d1)), 0
        while len(left):
            size = max(64, len(left) * 3 // 2)
            at = self._bit(d1[left], d2[left], size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, np.cumsum(alone) - alone + given))
            given += int(alone.sum())
            left = left[~alone[at]]
        self.d1, self.d2 = np.empty(len(d1), np.int64), np.empty(len(d1), np.int64)
        at = self._slots(d1, d2)
        self.d1[at], self.d2[at] = d1, d2

    def _bit(self, d1: np.ndarray, d2: np.ndarray, size: int, level: int | None = None) -> np.ndarray:
        salt = np.uint64((len(self.levels) if level is None else level) * 0x9E3779B97F4A7C15 % 2**64)
        mix = mixed(d1.astype(np.uint64) + salt) + d2.astype(np.uint64)
        return (mixed(mix) % np.uint64(size)).astype(np.int64)

    def _slots(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        out, left = np.full(len(d1), -1), np.arange(len(d1))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._bit(d1[left], d2[left], len(alone), level)
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out

    def slots(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 for those that are not in the table."""
        at = self._slots(d1, d2)
        if not len(self.d1):
            return at
        same = (self.d1[at] == d1) & (self.d2[at] == d2) & (at >= 0)
        return np.where(same, at, -1)


NODE = ["d1", "d2", "p1", "p2", "depth", "conv_id", "size", "n_convs", "n_ends"]
BELOW = ["below_convs", "below_nodes", "below_leaves", "below_saved"]
SUMMED = "d1 long, d2 long, p1 long, p2 long, depth long, conv_id long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"


def accumulated(nodes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Children, leaves and saved tokens of the nodes of one table. ``below_*`` is what
    children in other tables have brought."""
    table = SlotTable(nodes["d1"], nodes["d2"])
    slot = table.slots(nodes["d1"], nodes["d2"])
    flat = {}
    for name, values in nodes.items():
        flat[name] = np.empty(len(slot), np.int64)
        flat[name][slot] = values
    parent = table.slots(flat["p1"], flat["p2"])
    parent[flat["depth"] == 0] = -1
    convs, kids, leaves, saved = (flat[c] for c in BELOW)
    order = np.argsort(-flat["depth"], kind="stable")
    cuts = np.flatnonzero(np.diff(flat["depth"][order])) + 1
    for level in np.split(order, cuts):
        alone = flat["n_convs"][level] - flat["n_ends"][level] - convs[level]  # children with one member
        kids[level] += alone
        leaves[level] += alone + (kids[level] == 0)
        saved[level] += (flat["n_convs"][level] - 1) * flat["size"][level]
        inner = level[parent[level] >= 0]
        up = parent[inner]
        for to, value in ((convs, flat["n_convs"][inner]), (kids, 1), (leaves, leaves[inner]), (saved, saved[inner])):
            np.add.at(to, up, value)
    above = np.where(parent >= 0, flat["conv_id"][parent], 0)
    return {
        **{c: flat[c] for c in ("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs")},
        "parent_conv_id": np.ma.array(above, mask=parent < 0),
        "n_children": kids,
        "n_leaves": leaves,
        "saved_tokens": saved,
    }


def _tables(nodes: DataFrame, unit: int) -> DataFrame:
    """The nodes of a partition, sorted by shard, in tables of whole shards."""
    columns = [*NODE, *BELOW, "s1", "s2"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def made() -> pa.RecordBatch:
            whole = {c: np.concatenate([part[c] for part in held]) for c in [*NODE, *BELOW]}
            found = accumulated(whole)
            above = found.pop("parent_conv_id")
            arrays = [pa.array(found[c]) if c in found else pa.array(above.data, mask=np.ma.getmaskarray(above)) for c in names]
            return pa.record_batch(arrays, names)

        last = None
        for batch in batches:
            arrays = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
            shard = np.stack([arrays["s1"], arrays["s2"]])
            cuts = [0, *(np.flatnonzero((shard[:, 1:] != shard[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in itertools.pairwise(cuts):
                if a == b:
                    continue
                mine = (int(shard[0, a]), int(shard[1, a]))
                if mine != last and sum(len(p["d1"]) for p in held) >= unit:
                    yield made()
                    held = []
                last = mine
                held.append({c: arrays[c][a:b] for c in [*NODE, *BELOW]})
        if held:
            yield made()

    names = [f.split()[0] for f in SUMMED.split(", ")]
    return nodes.select(*columns).mapInArrow(add_up, SUMMED)


def _ends(pieces: DataFrame) -> DataFrame:
    """d1, d2, ends_sha256: of each node in which conversations end. Their ids are packed
    by the range they were read in, so that blocks follow each other by their first id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for row in batch.select(["conv_id", "part", "whole", "last", "at", "total"]).to_pylist():
                place = row["part"] if row["whole"] else ~row["conv_id"]  # others one by one
                groups.setdefault((row["whole"], place, row["last"]), []).append(row["conv_id"])
            rows = [(*np.frombuffer(k[2], DIGEST)[0].tolist(), min(v), np.sort(np.array(v, "<i8")).tobytes()) for k, v in groups.items()]
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["d1", "d2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def made() -> pa.RecordBatch:
            return pa.record_batch([[node[0]], [node[1]], [sha.hexdigest()]], ["d1", "d2", "ends_sha256"])

        rows = (row for batch in sliced(batches, 256) for row in batch.to_pylist())
        for row in rows:
            ids = ",".join(map(str, np.frombuffer(row["ids"], "<i8").tolist())).encode()
            if (row["d1"], row["d2"]) == node:
                sha.update(b"," + ids)
                continue
            if node is not None:
                yield made()
            node, sha = (row["d1"], row["d2"]), hashlib.sha256(ids)
        if node is not None:
            yield made()

    last = F.expr(f"substring(digests, -{DIGEST.itemsize}, {DIGEST.itemsize})")
    n = F.octet_length("turns") / TURN.itemsize
    ended = pieces.withColumn("last", last).filter(F.col("at") + n == F.col("total"))
    packed = ended.select("conv_id", "part", "whole", "last", "at", "total").mapInArrow(
        pack, "d1 long, d2 long, first long, ids binary"
    )
    ordered = packed.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first")
    return ordered.mapInArrow(digest, "d1 long, d2 long, ends_sha256 string")


def trie(pieces: DataFrame, most: int = MOST, unit: int = UNIT) -> DataFrame:
    """The nodes of the trie of ``paths``: d1, d2 (digest), p1, p2 (its parent's),
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    big = _big_nodes(pieces, most)
    nodes = stored(_nodes(_entries(_begun_in(pieces, big), big)), "trie-nodes")
    zero = F.lit(0).cast("long")
    shared = nodes.filter("s1 IS NOT NULL AND n_convs > 1").withColumns(dict.fromkeys(BELOW, zero))
    sharded = shared.repartition("s1", "s2").sortWithinPartitions("s1", "s2")
    low = stored(_tables(sharded, unit), "trie-low")
    roots = low.filter("parent_conv_id IS NULL AND depth > 0")
    sums = [F.sum("n_convs"), F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")]
    under = roots.groupBy("p1", "p2").agg(*[s.alias(c) for s, c in zip(sums, BELOW, strict=True)])
    under = under.withColumnsRenamed({"p1": "d1", "p2": "d2"})
    tops = nodes.filter("s1 IS NULL").join(under, ["d1", "d2"], "left").fillna(0, BELOW).fillna(0, ["s1", "s2"])
    high = stored(_tables(tops.coalesce(1), unit), "trie-high")  # MOST_BIG nodes at most
    single = nodes.filter("s1 IS NOT NULL AND n_convs = 1").select(
        "d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs",
        F.lit(None).cast("long").alias("parent_conv_id"),
        (1 - F.col("n_ends")).alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
    )

    def parents(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("above"))

    # a parent with very many children is a big node; the others are met by a shuffled join
    tops_known = F.broadcast(parents(high))
    orphans = single.unionByName(roots).join(tops_known, ["p1", "p2"], "left")
    found = orphans.filter("above IS NOT NULL")
    rest = orphans.filter("above IS NULL").drop("above").join(parents(low), ["p1", "p2"], "left")
    over = found.unionByName(rest).withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    )
    settled = low.filter("parent_conv_id IS NOT NULL OR depth = 0").unionByName(high)
    whole = over.drop("above").unionByName(settled)
    ends = F.coalesce("ends_sha256", F.lit(NONE_SHA)).alias("ends_sha256")
    return whole.join(_ends(pieces), ["d1", "d2"], "left").select(*whole.columns, ends)
