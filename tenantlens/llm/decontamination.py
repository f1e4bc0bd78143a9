r"""Benchmark decontamination by size-partitioned MinHash containment search.

An item lies in a document if at least ``percent`` in 100 of its distinct ``n``-word
shingles do (words ``[^\x20\x09-\x0D]+``, A-Z lower-cased; an item of fewer words is
one shingle of its own length). Jaccard similarity is useless here, a short item
being a small part of a long text, so:

* An item's signature are its ``size - ceil(size * percent / 100) + 1`` smallest
  shingle hashes. A document that contains the item holds at least one of them:
  the search misses nothing.
* Documents are partitioned by size in powers of two. A partition is searched
  for the items that fit into it, and only a document's hashes up to the largest
  signature value of those items are looked up.
* Candidates are verified on the words themselves, shingle by shingle.

Scale: one pass over the documents, no shuffle but that of the matches. Items are sent
to the tasks in blocks of about ``BLOCK_WORDS`` words; a larger benchmark takes several
passes. Equal texts of items are one item to the search, however often they come.

Defined cases: null and empty texts, and items without words, are in nothing and
hold nothing; repeated items are found each; an item without an id is found like
others and told with a null id; rows of the same id, or without one, are judged each
for itself; very long texts are searched whole, one at a time; an empty table of
documents or of items gives an empty result; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import WordHashes, gram_hashes, texts, words_of

BLOCK_WORDS = 2_000_000


class Signatures:
    """Items of one shingle length, their signatures partitioned by document size."""

    def __init__(self, n: int, items: list[tuple[str, list[bytes]]], percent: int):
        known = WordHashes()
        self.n, self.items = n, []
        values, owners, needs = [], [], []
        for item_id, words in items:
            grams = gram_hashes(known.of(words), n)
            hashes, first = np.unique(grams, return_index=True)
            need = -(-len(hashes) * percent // 100)
            k = len(hashes) - need + 1
            values.append(hashes[:k])
            owners.append(np.full(k, len(self.items)))
            needs.append(np.full(k, need))
            self.items.append((item_id, need, {int(h): words[i : i + n] for h, i in zip(hashes, first, strict=True)}))
        order = np.argsort(np.concatenate(values))
        self.values, self.owners, needs = (np.concatenate(x)[order] for x in (values, owners, needs))
        # by the bit length of a document's size: the largest value any item that fits in has
        self.most = [
            self.values[needs < 1 << bits].max(initial=0) if (needs < 1 << bits).any() else None for bits in range(65)
        ]

    def search(self, words: list[bytes], hashes: np.ndarray) -> Iterator[tuple[str, int, int]]:
        """item, size of its set, shingles shared, of all items in the text."""
        grams = gram_hashes(hashes, self.n)
        if not len(grams) or (most := self.most[len(grams).bit_length()]) is None:
            return
        sketch = grams[grams <= most]
        at = np.minimum(np.searchsorted(self.values, sketch), len(self.values) - 1)
        hits = np.unique(sketch[self.values[at] == sketch])
        if not len(hits):
            return
        low, high = (np.searchsorted(self.values, hits, side) for side in ("left", "right"))
        owners = np.unique(np.concatenate([self.owners[a:b] for a, b in zip(low, high, strict=True)]))
        distinct, first = np.unique(grams, return_index=True)
        place = dict(zip(distinct.tolist(), first.tolist(), strict=True))
        for item_id, need, shingles in (self.items[i] for i in owners):
            common = sum(words[p : p + self.n] == s for h, s in shingles.items() if (p := place.get(h)) is not None)
            if common >= need:
                yield item_id, len(shingles), common


def matches(text: bytes | None, block: list[Signatures], known: WordHashes) -> Iterator[tuple[str, int, int]]:
    words = words_of((text or b"").lower())
    hashes = known.of(words)
    for own in block:
        yield from own.search(words, hashes)


def signatures(items: DataFrame, n: int, percent: int) -> list[Signatures]:
    """One per shingle length of the items; for a block that fits the driver."""
    by_length: dict[int, list] = {}
    for row in items.select("item", "text").toArrow().to_pylist():
        words = words_of((row["text"] or "").encode().lower())
        if words:
            by_length.setdefault(min(n, len(words)), []).append((row["item"], words))
    return [Signatures(length, own, percent) for length, own in sorted(by_length.items())]


def digest() -> Column:
    return F.sha2(F.col("text"), 256)


def item_blocks(items: DataFrame, n: int, percent: int) -> Iterator[list[Signatures]]:
    """Signatures of all different item texts, named by their digests, in blocks of bounded size."""
    items = items.filter("text IS NOT NULL").select(digest().alias("item"), "text").distinct()
    letters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(letters // (2 * BLOCK_WORDS)) + 1  # a word and its space are two characters at least
    for block in range(blocks):
        yield signatures(items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block), n, percent)


def leaks(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, item_id, n_item, n_common, containment: a row per item that lies in a document.

    Different texts are searched for; each match is then told for all items of that text."""
    names = ["doc_id", "item", "n_item", "n_common", "containment"]
    out = None
    for block in item_blocks(items, n, percent):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = WordHashes()
            for batch in batches:
                found = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                    for item, size, common in matches(text, shared.value, known):
                        found.append((doc_id, item, size, common, common / size))
                columns = list(zip(*found, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        rows = docs.select("doc_id", "text").mapInArrow(
            search, "doc_id long, item string, n_item long, n_common long, containment double"
        )
        out = rows if out is None else out.unionByName(rows)
    ids = items.filter("text IS NOT NULL").select(digest().alias("item"), F.col("item_id").cast("long").alias("item_id"))
    return out.join(ids, "item").select("doc_id", "item_id", *names[2:])


def without_leaks(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose text holds no item."""
    for block in item_blocks(items, n, percent):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = WordHashes()
            for batch in batches:
                ok = [next(matches(t, shared.value, known), None) is None for t in texts(batch)]
                yield batch.filter(pa.array(ok, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
