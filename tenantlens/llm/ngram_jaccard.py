r"""Jaccard join of documents on word n-grams, by grouped prefixes.

A document's set holds its distinct ``n``-word shingles (words
``[^\x20\x09-\x0D]+``, A-Z lower-cased; a shorter text is one shingle of its own).
Two documents link when ``100 * |intersection| >= percent * |union|``.

All sets are ordered alike: rare shingles by hash, then heavy ones by their
count. Two sets that link share a shingle among the first
``size - ceil(size * percent / 100) + 1`` of each, their prefixes.

1. Equal sets form one class; copies meet in the reading task before anything is
   shuffled. Classes of the same size and prefix form one group, which one of
   them stands for.
2. Prefix shingles are dealt out in packed blocks; what only one class holds
   leaves there. Heavy shingles are spread by row instead, so none of them fills a task.
3. Groups that follow each other in many lists (in a few orders, all from one shuffle), and
   each group's members, are verified first: most of a cluster comes together here.
4. Groups are expanded: this pass joins classes, not groups. All pairs of a list that are not yet in one component follow, filtered by
   size, by the positions of the shared shingles and by their number, and are verified.

To verify a pair, the bitmaps of both sets, as wide as the sets are large, are compared
first; whole sets are made and moved only for what passes, which are few pairs more than
those that link.

A pair that is already connected needs no check, so a cluster of L near copies
costs about L checks and not L squared, and no link between components is lost.
``jaccard_links`` and ``class_links`` give all links instead, inside components too:
groups are joined and filtered by their first class, and what is left is expanded to
members and verified, which costs a check per pair.

Heavy shingles are found over the whole corpus: each task reports what
``LOCAL_DOCS`` or more documents of a slice hold, and the ``MOST_HEAVY`` of the
largest sums are sent to all tasks (2 x 8 bytes each). They only set the order, for
which any choice gives the same links.

Defined cases: a null or empty text has an empty set and no link. Repeated rows
are copies; rows of one id and different texts are documents of their own. Ids are below 2^62; a document without one links like others, and a
component of none but such has a null id. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import WordHashes, give_back, likely_in, mixed, shingles, signed, sliced, stored, texts, words_of
from tenantlens.llm.components import components
from tenantlens.llm.substring_dedup import NO_ID, identity, rank

LOCAL_DOCS = 4  # of a slice of the reading task
MOST_HEAVY = 250_000
ORDERS = 3
BLOCK_ENTRIES = 500_000  # prefix entries of a part, about
SPREAD = 64  # tasks, at least, that share the heavy shingles
LEAST_BITS, MOST_BITS = 9, 10  # binary digits of the width of a bitmap in the lists
WIDEST_BITS = 16  # and of one that a pair is compared by
LIST_BYTES = 6  # of a shingle's hash name its list; lists that share a name are compared as one
FOLLOWED = 200_000  # rows of lists put into their orders at once
SMALL_UNIT = 64  # rows of a unit that is compared together with others
LIST_ROWS = 500  # rows of a block of a list
COMPARED_WORDS = 1 << 20  # of bitmaps compared at once
EXPANDED = 1 << 18  # pairs of rows looked at together, about
LISTED = ["token", "size", "pos", "node"]


def sets_of(batch: pa.RecordBatch, known: WordHashes, n: int) -> list[np.ndarray]:
    return [shingles(known.of(words_of((t or b"").lower())), n) for t in texts(batch)]


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """Order-free 128-bit digest of a set."""
    one = np.add.reduce(mixed(tokens ^ np.uint64(0x1234567)), dtype=np.uint64)
    two = np.add.reduce(mixed(tokens * np.uint64(3) + np.uint64(0x7654321)), dtype=np.uint64)
    return int(one), int(two)


def parity(tokens: np.ndarray) -> bytes:
    """Bitmap of a set: bit ``b`` tells whether an odd number of shingles falls on
    it. Two sets that differ in ``d`` shingles have bitmaps that differ in ``d`` bits at most;
    the halves of a bitmap, XORed, are the bitmap of half the width."""
    width = 1 << min(WIDEST_BITS, max(LEAST_BITS, max(0, len(tokens) - 1).bit_length()))
    at = (mixed(tokens + np.uint64(0x51ED270B)) & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def narrow(bitmap: bytes) -> bytes:
    """The bitmap that lists carry."""
    if len(bitmap) <= 1 << MOST_BITS - 3:
        return bitmap
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, 1 << MOST_BITS - 6), axis=0).tobytes()


def prefix_size(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


def described(docs: DataFrame, n: int) -> DataFrame:
    """A row per document (rank, text_key, size, g1, g2, bits, and wide where that is another
    bitmap), and rows of heavy shingles (g1: shingle, size: documents)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in sliced(batches):
            found = sets_of(batch, known, n)
            digests = np.array([set_digest(s) for s in found], np.uint64).reshape(-1, 2)
            distinct = np.unique(digests, axis=0, return_index=True)[1]
            local, count = np.unique(np.concatenate([found[i] for i in distinct] or [np.empty(0, np.uint64)]), return_counts=True)
            local, count = local[count >= LOCAL_DOCS], count[count >= LOCAL_DOCS]
            k = len(local)
            bitmaps = [parity(s) for s in found]
            wide = [b if len(b) > 1 << MOST_BITS - 3 else None for b in bitmaps]
            yield pa.record_batch(
                [
                    pa.concat_arrays([batch.column(c), pa.nulls(k, pa.int64())])
                    for c in ("rank", "text_key")
                ]
                + [
                    pa.array(np.concatenate([[len(s) for s in found], count]).astype(np.int64)),
                    pa.array(np.concatenate([signed(digests[:, 0]), signed(local)])),
                    pa.concat_arrays([pa.array(signed(digests[:, 1].copy())), pa.nulls(k, pa.int64())]),
                    pa.array([narrow(b) for b in bitmaps] + [None] * k, pa.binary()),
                    pa.array(wide + [None] * k, pa.binary()),
                ],
                ["rank", "text_key", "size", "g1", "g2", "bits", "wide"],
            )

    return docs.select("text", "rank", "text_key").mapInArrow(
        describe, "rank long, text_key long, size long, g1 long, g2 long, bits binary, wide binary"
    )


class Order:
    """Rare shingles by hash, then heavy ones by rising count."""

    def __init__(self, heavy: pd.DataFrame):
        tokens = heavy["g1"].to_numpy(np.int64).view(np.uint64)
        place = np.lexsort((tokens, heavy["n"].to_numpy()))
        places = np.empty(len(tokens), np.int64)
        places[place] = np.arange(len(tokens))
        by_token = np.argsort(tokens)
        self.tokens, self.places = tokens[by_token], places[by_token]

    def prefix(self, tokens: np.ndarray, size: int) -> tuple[np.ndarray, int]:
        """The first shingles, and how many of them are rare."""
        if not len(self.tokens):
            return tokens[:size], size
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        is_heavy = self.tokens[at] == tokens
        rare = tokens[~is_heavy][:size]
        if len(rare) == size:
            return rare, size
        known = np.argsort(self.places[at[is_heavy]], kind="stable")
        return np.concatenate([rare, tokens[is_heavy][known][: size - len(rare)]]), len(rare)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value, byte by byte: those that are alike follow each other."""
    return values.view(np.uint8).reshape(len(values), -1)[:, :width].T.tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view(np.int64)[:, 0]


def shared_prefixes(docs: DataFrame, order, parts: int, n: int, percent: int) -> DataFrame:
    """token, pos, g1 (set): entries of shingles that several classes may hold. A set is
    named by half its digest: two that share a name get the entries of both, which adds
    candidates and loses none."""
    spread_over = max(SPREAD, parts)
    entry = np.dtype([("token", "<u8"), ("doc", "<u4"), ("pos", "<u4")])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ordered = WordHashes(), order.value
        for batch in sliced(batches):
            seen: set[tuple[int, int]] = set()
            heads, rows, spread = [], [], []
            for tokens in sets_of(batch, known, n):
                if not len(tokens) or (digest := set_digest(tokens)) in seen:
                    continue
                seen.add(digest)
                prefix, rare = ordered.prefix(tokens, prefix_size(len(tokens), percent))
                made = np.empty(len(prefix), entry)
                made["token"], made["doc"], made["pos"] = prefix, len(heads), np.arange(len(prefix))
                rows.append(made)
                spread.append(np.arange(len(prefix)) >= rare)
                heads.append(digest[0])
            if not rows:
                continue
            all_heads, all_rows, heavy = np.array(heads, np.uint64).view(np.int64), np.concatenate(rows), np.concatenate(spread)
            all_rows["token"] &= np.uint64((1 << 8 * LIST_BYTES) - 1)
            part = (mixed(all_rows["token"]) % np.uint64(parts)).astype(np.int64)
            salt = -1 - (all_rows["doc"] + all_heads[0] % spread_over).astype(np.int64) % spread_over
            part[heavy] = salt[heavy]
            by_part = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[by_part])) + 1
            blocks = []
            for chosen in np.split(by_part, cuts):
                docs_in, doc = np.unique(all_rows["doc"][chosen], return_inverse=True)
                token, pos = all_rows["token"][chosen], all_rows["pos"][chosen]
                packed = _planes(token, LIST_BYTES), _planes(doc.astype("<u4"), 4), _planes(pos, 4)
                blocks.append((int(part[chosen[0]]), all_heads[docs_in].tobytes(), *packed))
            kinds = (pa.int64(), *[pa.binary()] * 4)
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(zip(*blocks, strict=True), kinds, strict=True)], dealt_columns
            )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in dealt_columns), strict=True)

        for part, group in groupby(blocks(), key=lambda b: b[0]):
            one_of_each, held, size = None, [], 0  # an entry of each shingle of the part met so far
            for _, *packed in group:
                found = flat(*packed)
                if part < 0:  # heavy shingles: all are shared
                    yield from batches_of(found)
                    continue
                held.append(found)
                size += len(found)
                if size >= 2 * BLOCK_ENTRIES:
                    shared, one_of_each = repeated(one_of_each, np.concatenate(held))
                    yield from batches_of(shared)
                    held, size = [], 0
            if held:
                yield from batches_of(repeated(one_of_each, np.concatenate(held))[0])
        one_of_each, held = None, []
        give_back()

    dealt_columns = ["part", "heads", "token", "doc", "pos"]
    row = np.dtype([("token", "<i8"), ("pos", "<i4"), ("g1", "<i8"), ("told", "?")])

    def flat(heads: bytes, token: bytes, doc: bytes, pos: bytes) -> np.ndarray:
        tokens = _from_planes(token, LIST_BYTES)
        out = np.zeros(len(tokens), row)
        out["token"], out["pos"] = tokens, _from_planes(pos, 4)
        out["g1"] = np.frombuffer(heads, "<i8")[_from_planes(doc, 4)]
        return out

    def repeated(before: np.ndarray | None, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose shingle another class has too, and a row of each shingle."""
        rows = rows if before is None else np.concatenate([before, rows])
        rows = rows[np.argsort(rows["token"], kind="stable")]
        again = rows["token"][1:] == rows["token"][:-1]
        many = np.concatenate([again, [False]]) | np.concatenate([[False], again])
        alone, rows = rows[~many], rows[many]
        rows = rows[np.lexsort([~rows["told"], rows["pos"], rows["g1"], rows["token"]])]
        copy = np.all([rows[c][1:] == rows[c][:-1] for c in ("token", "g1", "pos")], axis=0)
        rows = rows[np.concatenate([[True], ~copy])[: len(rows)]]
        same = rows["token"][1:] == rows["token"][:-1]
        shared = (np.concatenate([same, [False]]) | np.concatenate([[False], same]))[: len(rows)]
        out = rows[shared & ~rows["told"]]
        rows["told"] |= shared
        return out, np.concatenate([alone, rows[np.concatenate([[True], ~same])[: len(rows)]]])

    def batches_of(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 200_000):
            some, names = rows[at : at + 200_000], ["token", "pos", "g1"]
            yield pa.record_batch([pa.array(np.ascontiguousarray(some[c])) for c in names], names)

    dealt = docs.select("text").mapInArrow(deal, "part long, heads binary, token binary, doc binary, pos binary")
    return (
        dealt.repartition(parts + spread_over, "part")
        .sortWithinPartitions("part")
        .mapInArrow(match, "token long, pos int, g1 long")
    )


def least_shared(percent: int) -> Column:
    """How many prefix shingles two sets of sizes sa and sb must share to link.

    What they share beyond their prefixes lies after the prefix that ends first,
    so it is not more than a set has there.
    """

    def part(size: Column, of: int) -> Column:
        return F.floor((size * percent + (of - 1)) / of)

    beyond = F.greatest(part(F.col("sa"), 100), part(F.col("sb"), 100)) - 1
    return F.greatest(F.lit(1), part(F.col("sa") + F.col("sb"), 100 + percent) - beyond)


def group_members(entries: DataFrame) -> DataFrame:
    """a, b: the first class of each group of equal size and prefix, and each other class of
    it. Two classes of one prefix (of ``prefix`` shingles) have all of it among the entries."""
    marks = [F.bit_xor(F.xxhash64("token", "pos", F.lit(i))).alias(f"h{i}") for i in range(2)]
    marked = entries.groupBy("node", "size", "prefix").agg(*marks, F.count("*").alias("n"))
    marked = stored(marked.filter("n = prefix").drop("n", "prefix"), "marked")
    key = ["h0", "h1", "size"]
    groups = marked.groupBy(*key).agg(F.min("node").alias("a"), F.max("node").alias("last"))
    members = marked.join(groups.filter("a < last").drop("last"), key).filter("node <> a")
    return members.select("a", F.col("node").alias("b"))


def neighbours(lists: DataFrame, percent: int) -> DataFrame:
    """a, b: classes that follow each other in enough lists to be likely links.

    Lists are sorted by size, and in ``ORDERS`` ways by a hash of the class. An
    order is the same in all lists, so members of a cluster that share many
    shingles meet in many lists; with several orders few of them stay alone. Long
    lists are cut by size into pieces, which are put into their orders each.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, size, node in pieces(batches):
            for order in range(ORDERS + 1):
                if order:
                    by = mixed(node.view(np.uint64) + np.uint64(order << 50))
                    at = np.lexsort([by, token])
                    token, size, node = token[at], size[at], node[at]
                low, high = np.minimum(size[:-1], size[1:]), np.maximum(size[:-1], size[1:])
                near = (token[1:] == token[:-1]) & (node[1:] != node[:-1]) & (100 * low >= percent * high)
                ends = [c[near] for c in (np.minimum(node[:-1], node[1:]), np.maximum(node[:-1], node[1:]), low, high)]
                yield pa.record_batch([pa.array(c) for c in [np.full(len(ends[0]), order), *ends]], ["by", "a", "b", "sa", "sb"])
        give_back()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("token", "size", "node")])
            rows += batch.num_rows
            if rows < FOLLOWED:
                continue
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            open_from = int(np.searchsorted(whole[0], whole[0][-1]))  # its last list may go on
            open_from = open_from if rows - open_from < FOLLOWED // 2 else rows
            yield [c[:open_from] for c in whole]
            held, rows = [[c[open_from:] for c in whole]], rows - open_from
        if rows:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]

    by = ["token", "size", "node"]
    ordered = lists.select("token", F.col("size").cast("long"), "node").repartitionByRange(*by).sortWithinPartitions(*by)
    pairs = ordered.mapInArrow(follow, "by long, a long, b long, sa long, sb long")
    counted = pairs.groupBy("by", "a", "b").agg(F.count("*").alias("n"), F.max("sa").alias("sa"), F.max("sb").alias("sb"))
    return counted.filter(2 * F.col("n") >= least_shared(percent)).select("a", "b").distinct()


def missing_pairs(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of different components that may link, by the lists they share (with
    ``blocks``, those of the list). ``classes`` have node, component, bits.

    A list is compared in units of bounded size: its rows are dealt into blocks, and a
    unit holds two of them. In it pairs must pass by size and position (nothing
    before the first shared shingle is shared, so what follows bounds the overlap; at
    later ones a pair may fail, at its first it does not), and by bitmaps (each bit that
    differs is a shingle that only one set has). All filters are exact; only pairs that
    pass leave the task.
    """
    rows = lists.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.join(classes.select("node", "component", "bits"), "node")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    unit = F.explode(F.transform(others, lambda o: F.struct(F.least(o, "block").alias("i"), F.greatest(o, "block").alias("j"))))
    columns = [*LISTED, "component", "block", "bits"]
    units = rows.select(*columns, unit.alias("unit")).select(*columns, "unit.i", "unit.j")
    key = ["token", "i", "j"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for rows, starts in _units(batches, key):
            for made in close_pairs(rows, starts, percent):
                found.append(made)
                if sum(map(len, found)) >= 100_000:
                    yield _pairs(found)
                    found = []
        yield _pairs(found)
        give_back()

    ordered = units.repartition(*key).sortWithinPartitions(*key)
    return ordered.mapInArrow(match, "a long, b long").distinct()


def blocks_of_list() -> Column:
    return F.ceil(F.count("*") / F.lit(float(LIST_ROWS))).cast("int").alias("blocks")


def reaches_far(percent: int) -> Column:
    """Whether enough of a set follows its place in a list, beside the smallest set of the
    list that it could link with: for larger ones more would have to follow."""
    partner = F.greatest("least", F.ceil(F.col("size") * percent / F.lit(100)))
    need = F.ceil((F.col("size") + partner) * percent / F.lit(100 + percent))
    return F.col("pos") + need <= F.col("size")


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    each = np.unique(np.concatenate([*found, np.empty((0, 2), np.int64)]), axis=0)
    return pa.record_batch([pa.array(each[:, 0].copy()), pa.array(each[:, 1].copy())], ["a", "b"])


def _units(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Rows of whole units, which follow each other, and where each unit starts."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if held is not None:
            rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
        if not len(rows["node"]):
            continue
        change = np.any([rows[c][1:] != rows[c][:-1] for c in key], axis=0)
        starts = np.flatnonzero(np.concatenate([[True], change]))
        last = starts[-1]  # this unit may go on
        held = {c: v[last:] for c, v in rows.items()}
        if last:
            yield {c: v[:last] for c, v in rows.items()}, starts[:-1]
    if held is not None:
        yield held, np.zeros(1, np.int64)


def close_pairs(rows: dict[str, np.ndarray], starts: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Pairs of the units that pass the filters, as arrays of (smaller node, larger node).

    Small units are compared together, all pairs of their rows at once; in a large one
    rows of one size and one place in the list are compared as one first.
    """
    stops = np.append(starts[1:], len(rows["node"]))
    counts = stops - starts
    widths = np.fromiter(map(len, rows["bits"]), np.int64, len(rows["node"]))
    for a, b in zip(starts[counts > SMALL_UNIT].tolist(), stops[counts > SMALL_UNIT].tolist(), strict=True):
        yield from _of_large({c: v[a:b] for c, v in rows.items()}, widths[a:b], percent)
    small = counts <= SMALL_UNIT
    right = np.flatnonzero(np.repeat(small, counts))
    before = right - np.repeat(starts[small], counts[small])  # rows of the unit before each row
    done = np.cumsum(before)
    for at in np.split(np.arange(len(right)), np.searchsorted(done, np.arange(EXPANDED, done[-1] if len(done) else 0, EXPANDED))):
        some = before[at]
        right_of = np.repeat(right[at], some)
        inside = np.arange(len(right_of)) - np.repeat(np.cumsum(some) - some, some)
        left_of = np.repeat(right[at] - some, some) + inside
        yield from _close(rows, left_of, right_of, widths, percent)


def _of_large(unit: dict[str, np.ndarray], widths: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    order = np.lexsort([unit["size"], unit["pos"]])
    unit, widths = {c: v[order] for c, v in unit.items()}, widths[order]
    change = np.any([unit[c][1:] != unit[c][:-1] for c in ("size", "pos")], axis=0)
    starts = np.flatnonzero(np.concatenate([[True], change]))
    counts = np.diff(np.append(starts, len(order)))
    size, pos = unit["size"][starts], unit["pos"][starts]
    step = max(1, COMPARED_WORDS // len(starts))
    for at in range(0, len(starts), step):
        one = np.arange(at, min(at + step, len(starts)))[:, None]
        two = np.arange(len(starts))[None, :]
        x, y = np.nonzero((one <= two) & _may_link(size[one], pos[one], size[two], pos[two], percent))
        x = x + at
        products = np.cumsum(counts[x] * counts[y])
        for part in np.split(np.arange(len(x)), np.searchsorted(products, np.arange(EXPANDED, products[-1] if len(x) else 0, EXPANDED))):
            if not len(part):
                continue
            total = counts[x[part]] * counts[y[part]]
            pair = np.repeat(part, total)
            inside = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
            left = starts[x[pair]] + inside // counts[y[pair]]
            right = starts[y[pair]] + inside % counts[y[pair]]
            ahead = left < right
            yield from _close(unit, left[ahead], right[ahead], widths, percent)


def _may_link(sa: np.ndarray, pa_: np.ndarray, sb: np.ndarray, pb: np.ndarray, percent: int) -> np.ndarray:
    """By size and place in the list."""
    need = -(-(sa + sb) * percent // (100 + percent))
    return (pa_ + need <= sa) & (pb + need <= sb) & (100 * np.minimum(sa, sb) >= percent * np.maximum(sa, sb))


def _close(rows: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, widths: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """The close ones of these pairs of rows."""
    i, j = rows["i"][left], rows["j"][left]
    b, c = rows["block"][left], rows["block"][right]
    ok = rows["component"][left] != rows["component"][right]
    ok &= ((b == i) & (c == j)) | ((b == j) & (c == i))
    left, right = left[ok], right[ok]
    size, pos = rows["size"], rows["pos"]
    ok = _may_link(size[left], pos[left], size[right], pos[right], percent)
    left, right = left[ok], right[ok]
    narrower = np.minimum(widths[left], widths[right])
    for width in np.unique(narrower).tolist():
        chosen = np.flatnonzero(narrower == width)
        step = max(1, 8 * COMPARED_WORDS // width)
        for at in range(0, len(chosen), step):
            l, r = left[chosen[at : at + step]], right[chosen[at : at + step]]
            close = _alike(rows["bits"], l, rows["bits"], r, width, size[l] + size[r], percent)
            if close.any():
                yield np.sort(np.stack([rows["node"][l[close]], rows["node"][r[close]]], axis=1), axis=1)


def _alike(one: np.ndarray, l: np.ndarray, two: np.ndarray, r: np.ndarray, width: int, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bitmaps of rows ``l`` and ``r`` differ in so few bits that the sets, of
    ``both`` shingles together, may link."""
    differ = np.bitwise_count(_bitmaps(one, l, width) ^ _bitmaps(two, r, width)).sum(axis=1, dtype=np.int64)
    return differ <= both - 2 * -(-both * percent // (100 + percent))


def _bitmaps(bits: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of these rows, those that are wider folded to ``width`` bytes."""
    distinct, place = np.unique(rows, return_inverse=True)
    made = np.empty((len(distinct), width // 8), np.uint64)
    chosen = bits[distinct]
    own = np.fromiter(map(len, chosen), np.int64, len(chosen))
    for wide in np.unique(own).tolist():
        at = np.flatnonzero(own == wide)
        whole = np.frombuffer(b"".join(chosen[at].tolist()), np.uint64).reshape(len(at), -1, width // 8)
        made[at] = np.bitwise_xor.reduce(whole, axis=1)
    return made[place]


def alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by their bitmaps, which are as wide as the sets are
    large: of those that do not link few are left."""
    bitmap = classes.select("node", "size", F.coalesce("wide", "bits").alias("bitmap"))
    joined = pairs.join(bitmap.toDF("a", "sa", "x"), "a").join(bitmap.toDF("b", "sb", "y"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            both = batch.column("sa").to_numpy() + batch.column("sb").to_numpy()
            widths = np.fromiter((min(len(p), len(q)) for p, q in zip(x, y, strict=True)), np.int64, len(x))
            ok = np.zeros(len(x), bool)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                ok[at] = _alike(x, at, y, at, width, both[at], percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return joined.select("a", "b", "sa", "sb", "x", "y").mapInArrow(compare, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    links = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    return pairs.join(one, "a").join(two, "b").filter(links).select("a", "b").distinct()


def whole_sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """node, tokens: the sorted shingles of a document of each class (repeated rows may repeat it)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = WordHashes(), None
        for batch in sliced(batches):
            own = list(zip(batch.column("node").to_pylist(), batch.column("text_key").to_pylist(), strict=True))
            new = [key != before for key, before in zip(own, [last, *own], strict=False)]
            last = own[-1] if own else last
            batch = batch.filter(pa.array(new, pa.bool_()))
            made = [signed(s) for s in sets_of(batch, known, n)]
            yield pa.record_batch([batch.column("node"), pa.array(made, pa.list_(pa.int64()))], ["node", "tokens"])

    few = likely_in(docs.select("rank", "text_key", "text"), nodes, ("rank", "text_key"))
    joined = few.join(nodes, ["rank", "text_key"]).select("node", "text_key", "text")
    return joined.mapInArrow(encode, "node long, tokens array<long>")


def prepared(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the documents (with ``identity``), classes of equal sets, and entries of the lists they share."""
    spark = docs.sparkSession
    table = stored(described(docs, n), "sets")
    members = table.filter("rank IS NOT NULL")
    heavy = (
        table.filter("rank IS NULL")
        .groupBy("g1")
        .agg(F.sum("size").alias("n"))
        .orderBy(F.desc("n"), "g1")
        .limit(MOST_HEAVY)
        .toArrow()
        .to_pandas()
    )
    order = spark.sparkContext.broadcast(Order(heavy))
    classes = stored(
        members.filter("size > 0")
        .groupBy("g1", "g2")
        .agg(F.min(F.struct("rank", "text_key", "size", "bits", "wide")).alias("rep"), F.count("*").alias("n_copies"))
        .select("g1", "g2", "rep.*", "n_copies", F.monotonically_increasing_id().alias("node")),
        "classes",
    )
    total = members.agg(F.sum(F.col("size") * (100 - percent) / 100 + 1)).first()[0] or 0
    parts = int(total // BLOCK_ENTRIES) + 1
    found = shared_prefixes(docs, order, parts, n, percent)
    # equal rows, and a class's name, meet in the one shuffle by that name
    found = found.repartition("g1").dropDuplicates(["g1", "token", "pos"]).join(classes.select("g1", "node", "size"), "g1")
    return members, classes, stored(found.select("token", F.col("size").cast("int"), "pos", "node"), "entries")


def linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs of classes (a, b) that link."""
    pairs = stored(alike(pairs, classes, percent), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    reps = classes.select("node", "rank", "text_key").join(nodes, "node", "left_semi")
    sets = stored(whole_sets(docs, stored(reps, "representatives"), n), "whole-sets")
    return stored(verified(pairs, sets, percent), "links")


def labelled_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """rank, text_key, size, cluster (a class, null of empty sets), component (a rank), n_copies per document."""
    docs = identity(docs)
    members, classes, entries = prepared(docs, n, percent)
    prefix = F.col("size") - F.ceil(F.col("size") * percent / F.lit(100)) + 1
    others = stored(group_members(entries.withColumn("prefix", prefix)), "group-members")

    # one member stands for each group at first; then the groups are expanded
    leaders = entries.join(others.select(F.col("b").alias("node")), "node", "left_anti")
    first = linked(neighbours(leaders, percent).unionByName(others).distinct(), docs, classes, n, percent)
    near = stored(components(first), "near")
    labelled = entries.join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = F.min("component").alias("low"), F.max("component").alias("high"), F.min("size").alias("least")
    ends = labelled.groupBy("token").agg(*ends, blocks_of_list())
    # written first: a join of plain scans is one that adaptive execution can split at a hot shingle
    open_tokens = stored(ends.filter("low < high").select("token", "least", "blocks"), "open-tokens")
    lists = stored(entries.join(open_tokens, "token").filter(reaches_far(percent)).drop("least"), "open-lists")
    known = classes.select("node", "bits").join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    second = linked(missing_pairs(lists, known, percent), docs, classes, n, percent)
    labels = stored(components(first.unionByName(second)), "components")

    named = classes.join(labels, "node", "left").withColumn("cluster", F.coalesce("component", "node"))
    named = stored(named.select("g1", "g2", "rank", "n_copies", "cluster"), "named")
    least = named.groupBy("cluster").agg(F.min("rank").alias("component"))
    named = named.join(least, "cluster").select("g1", "g2", "n_copies", "cluster", "component")
    out = members.join(named, ["g1", "g2"], "left")
    component, copies = F.coalesce("component", "rank"), F.coalesce("n_copies", F.lit(1))
    return out.select("rank", "text_key", "size", "cluster", component.alias("component"), copies.alias("n_copies"))


def jaccard_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, n_copies (documents with the same set), per document."""
    return labelled_rows(docs, n, percent).select(
        F.when(F.col("rank") < NO_ID, F.col("rank")).alias("doc_id"),
        F.col("size").alias("n_shingles"),
        F.when(F.col("component") < NO_ID, F.col("component")).alias("component_id"),
        "n_copies",
    )


def class_links(docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, node, n_copies; no node: empty set) and all links (a, b) of classes, each once."""
    docs = identity(docs)
    members, classes, entries = prepared(docs, n, percent)
    lists = entries.join(stored(entries.groupBy("token").agg(blocks_of_list()), "list-blocks"), "token")
    links = linked(missing_pairs(lists, classes.withColumn("component", F.col("node")), percent), docs, classes, n, percent)
    rows = members.join(classes.select("g1", "g2", "node", "n_copies"), ["g1", "g2"], "left")
    return rows.select(F.when(F.col("rank") < NO_ID, F.col("rank")).alias("doc_id"), "node", "n_copies"), links


def jaccard_links(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_links (other documents that link with it, copies included), per document."""
    rows, links = class_links(docs, n, percent)
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.max("n_copies").alias("n_copies"))
    other = ends.join(sizes.toDF("b", "held"), "b").groupBy("a").agg(F.sum("held").alias("held"))
    found = F.coalesce("n_copies", F.lit(1)) - 1 + F.coalesce("held", F.lit(0))
    return rows.join(other.withColumnRenamed("a", "node"), "node", "left").select("doc_id", found.alias("n_links"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, all columns kept: that of its smallest id (of equal ids, one)."""
    rows = labelled_rows(docs, n, percent)
    alone = F.col("cluster").isNull()  # empty sets have no links
    by = ["cluster", F.when(alone, F.col("rank")).alias("r"), F.when(alone, F.col("text_key")).alias("t")]
    stay = rows.groupBy(*by).agg(F.min(F.struct("rank", "text_key")).alias("first")).select("first.*")
    stay = stored(stay.distinct(), "staying")
    keys = ["__rank", "__text_key"]
    stay = stay.toDF(*keys)
    kept = docs.withColumns({"__rank": rank(), "__text_key": F.xxhash64("text")})
    kept = kept.repartition(*keys).join(stay, keys)

    columns = docs.columns

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # repeated rows follow each other
        for batch in batches:
            own = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            new = [key != before for key, before in zip(own, [last, *own], strict=False)]
            last = own[-1] if own else last
            yield batch.filter(pa.array(new, pa.bool_())).select(columns)
        give_back()

    return kept.select(*columns, *keys).sortWithinPartitions(*keys).mapInArrow(first, docs.schema)
