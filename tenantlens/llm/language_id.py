r"""Language identification by language-bitmask n-gram filters.

Texts are lower-cased, everything ASCII that is no letter becomes white space,
and words are set between single spaces; n-grams are runs of four bytes of that.

Training takes the n-grams of each language's sample, all of them. All languages lie in
one bit-sliced Bloom filter: a position holds one bit per language, so ``HASHES``
look-ups, ANDed, return the mask of all languages that hold an n-gram; a language that
is added changes no other's bits. A document's score for a language is the
share of its n-grams with that bit, corrected for the filter's false positives
``(share - f) / (1 - f)``; the best one decides, the first by code point if equal.

Scale: one pass over the texts without a shuffle of any text. Training reads about
``SAMPLE_DOCS`` documents of each language, those of the smallest hashes of id and text,
repeated rows once; this sample is the only bound. What reaches the driver are the
different n-grams of the samples, and the filter made of them goes to all tasks.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is
every text if nothing could be learned. A text none of whose n-grams is known
gets the most frequent language with score 0. A null ``doc_id`` is not held out;
rows are judged each for itself; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tenantlens.llm.common import sliced, stored, texts

SAMPLE_DOCS = 4_000
HASHES = 3
BITS_PER_GRAM = 12
UNKNOWN = "und"
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)  # odd, high bits mixed
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams_of(text: str) -> np.ndarray:
    """All runs of four bytes, as numbers."""
    plain = b"  " + b" ".join(text.lower().encode().translate(_TO_SPACE).split()) + b"  "
    b = np.frombuffer(plain, np.uint8).astype(np.uint32)
    return b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)


def positions(grams: np.ndarray, size: int) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - (size - 1).bit_length())
    wide = grams.astype(np.uint64)
    wide ^= wide << np.uint64(29)
    for i in range(HASHES):
        yield (wide * _SPREAD[i]) >> shift


class LanguageFilter:
    """Bloom filters of all languages, sliced by position; eight languages a byte."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], default: int):
        self.languages, self.default = languages, default
        most = max((len(g) for g in grams), default=1)
        self.size = 1 << max(10, (BITS_PER_GRAM * max(1, most) - 1).bit_length())
        self.table = np.zeros((-(-len(languages) // 8), self.size), np.uint8)
        false = []
        for i, own in enumerate(grams):
            row, bit = self.table[i // 8], np.uint8(1 << i % 8)
            for at in positions(own, self.size):
                row[at] |= bit
            false.append(((row & bit) != 0).mean() ** HASHES)
        self.false = np.array(false)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram the bytes with a bit for each language that holds it."""
        first, *others = positions(grams, self.size)
        found = self.table[:, first]
        for at in others:
            found &= self.table[:, at]
        return found

    def shares(self, text: str) -> np.ndarray:
        """Share of the text's n-grams in each language, corrected for false positives."""
        found = self.masks(grams_of(text))
        counts = np.concatenate([np.bincount(row, minlength=256) @ _BITS for row in found])
        share = counts[: len(self.languages)] / found.shape[1]
        return np.clip((share - self.false) / (1 - self.false), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0
        shares = self.shares(text)
        best = int(shares.argmax())
        if shares[best] <= 0:
            return self.languages[self.default], 0.0
        return self.languages[best], float(shares[best])


def gram_counts(sample: DataFrame) -> DataFrame:
    """lang, gram, n: how often each n-gram occurs in the texts of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            by_lang: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(texts(batch), batch.column("lang").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(grams_of(text.decode()))
            for lang, parts in by_lang.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"],
                )

    rows = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_sample(docs: DataFrame) -> DataFrame:
    """text, lang of about SAMPLE_DOCS documents per language, none held out."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = known.select("text", "lang", F.xxhash64("doc_id", "text").alias("mark"))
    share = F.lit(float(SAMPLE_DOCS)) / F.col("n")
    limit = F.when(share >= 1, F.lit(2**63 - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long"))
    counts = rows.groupBy("lang").agg(F.count_distinct("mark").alias("n"))
    limit = stored(counts.select("lang", limit.alias("limit")), "sample-limits")
    drawn = rows.join(limit, "lang").filter("mark <= limit")
    return drawn.dropDuplicates(["lang", "mark"]).select("text", "lang")


def learn(docs: DataFrame) -> LanguageFilter:
    """A filter from ``text`` and ``lang`` of the documents that are not held out."""
    counts = stored(gram_counts(training_sample(docs)), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = {r["lang"]: r["total"] for r in totals.collect()}  # a row per language
    languages = sorted(sizes, key=lambda x: x.encode())
    if not languages:
        return LanguageFilter([], [], 0)
    kept: pd.DataFrame = counts.select("lang", "gram").toArrow().to_pandas()  # of the samples alone
    own = [kept.loc[kept["lang"] == x, "gram"].to_numpy(np.int64) for x in languages]
    default = max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i))
    return LanguageFilter(languages, own, default)


def predictions(docs: DataFrame, learned: LanguageFilter, also: tuple[str, ...] = ()) -> DataFrame:
    """lang_pred, score of every row's text, beside the columns named in ``also``."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    schema = [*(docs.schema[c] for c in also)]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            found = [model.predict(None if t is None else t.decode()) for t in texts(batch)]
            yield pa.record_batch(
                [batch.column(c) for c in also]
                + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*also, "lang_pred", "score"],
            )

    out = StructType([*schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    read = docs.select(*dict.fromkeys([*also, "text"]))
    return read.mapInArrow(judge, out)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score per document, learned from the same table."""
    rows = docs.select("doc_id", "text", "lang")
    found = predictions(rows.select("doc_id", "text"), learn(rows), ("doc_id",))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def recognized(docs: DataFrame, learned: LanguageFilter, least_score: float) -> DataFrame:
    """The rows of ``docs``, all columns kept, in a learned language with ``least_score`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            found = [model.predict(None if t is None else t.decode()) for t in texts(batch)]
            yield batch.filter(pa.array([f[0] != UNKNOWN and f[1] >= least_score for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
