r"""Token ids in binary shards, each a wavelet matrix that answers without being unpacked.

Documents are tokenized and written in ascending ``doc_id`` order (nulls last,
equal ids by text) as shards of about ``SHARD_TOKENS`` ids. A shard file is

====================  =====================================================
magic                 ``WVM1``
head                  partition, sequence, bits a token (u32); documents, tokens (u64)
doc ids               i64 each, then a byte each: 1 if the id is null
sizes                 u64 each: tokens of the document, end id included
zeros                 u64 for each bit-plane
bit-planes            from the highest bit, packed in 64-bit words
rank directory        for each plane u32 ones before every 512 bits
====================  =====================================================

little-endian, closed by one newline, which Spark's text writer adds. Reading is
by ``binaryFile``. ``WaveletMatrix`` gives access, rank, count and select on the
planes as they lie in the file.

Scale: one range shuffle of the texts (packed ids of made-up words are as large as
compressed text), cut into shards as they stream by, so a task holds one shard whatever
the corpus. Spark's own commit protocol writes the
files: a task that is run again leaves no second copy. Offsets are sums over
shards within each partition, then over partitions.

Defined cases: a null or empty text has the end id alone; an empty table gives no
shard; repeated rows are encoded each; other columns take no part.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenantlens.llm.common import sliced, stored

MAGIC = b"WVM1"
HEAD = struct.Struct("<4sIIIQQ")
SHARD_TOKENS = 1 << 19
BATCH_DOCS = 500
CACHED_PIECES = 150_000  # of each Python worker, about 25 MB; others are encoded where they are met
SUPER = 512  # bits of a rank block
WORDS = SUPER // 64
# Latin letters; U+0130 is left out: in lower case it ends in a combining dot
LATIN = "ß-öø-įı-ɏ"
# one mark between a letter and white space is a token of its own either way
MARK = rf"([a-zÀ-ÖØ-Þ{LATIN}])([.,;:!?])([ \t\n\x0b\f\r]|$)"
# what the split of ``BY_WORD`` cuts into runs of letters, single digits and runs of marks:
# pieces without an apostrophe, which begins words of its own
PLAIN = re.compile(f"[!-&(-~{LATIN}]+")
WORDS_OF = re.compile(f"[a-z{LATIN}]+|[0-9]|[!-&(-/:-@[-`{{-~]+")
# the characters that stand for bytes in a ByteLevel vocabulary: themselves, or the next free ones
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: b for b in SHOWN} | dict(zip((b for b in range(256) if b not in SHOWN), range(256, 512), strict=False))
# fixed values: the steps of a vocabulary file that drop white space and lower-case
BY_WORD = [
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
]


class WaveletMatrix:
    """Bit-planes of a sequence, each stably parted into zeros and ones by the one above."""

    def __init__(self, size: int, bits: int, zeros: np.ndarray, planes: np.ndarray, ranks: np.ndarray):
        self.size, self.bits, self.zeros, self.planes, self.ranks = size, bits, zeros, planes, ranks

    @staticmethod
    def shape(size: int) -> tuple[int, int]:
        """64-bit words of a plane and entries of its directory."""
        blocks = size // SUPER + 1
        return blocks * WORDS, blocks

    @classmethod
    def build(cls, tokens: np.ndarray, bits: int) -> WaveletMatrix:
        size = len(tokens)
        words, blocks = cls.shape(size)
        zeros, planes = np.zeros(bits, np.uint64), np.zeros((bits, words), np.uint64)
        current = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits):
            one = (current & current.dtype.type(1 << (bits - 1 - level))) != 0
            packed = np.packbits(one, bitorder="little")
            planes[level].view(np.uint8)[: len(packed)] = packed
            first, last = current[~one], current[one]
            zeros[level] = len(first)
            current = np.concatenate([first, last])
        ones = np.bitwise_count(planes).reshape(bits, blocks, WORDS).sum(axis=2, dtype=np.uint32)
        ranks = np.cumsum(ones, axis=1, dtype=np.uint32) - ones
        return cls(size, bits, zeros, planes, ranks)

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        block, word = at // SUPER, at // 64
        total = self.ranks[level, block].astype(np.int64)
        for i in range(WORDS):
            total += np.where(i < word % WORDS, np.bitwise_count(self.planes[level, block * WORDS + i]), 0)
        below = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return total + np.bitwise_count(self.planes[level, word] & below)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Tokens at these positions."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level in range(self.bits):
            bit = ((self.planes[level, at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)
            ones = self.ones(level, at)
            out = out * 2 + bit
            at = np.where(bit, int(self.zeros[level]) + ones, at - ones)
        return out

    def _range(self, token: int, start: int, stop: int) -> np.ndarray:
        ends = np.array([start, stop], np.int64)
        for level in range(self.bits):
            ones = self.ones(level, ends)
            bit = token >> (self.bits - 1 - level) & 1
            ends = int(self.zeros[level]) + ones if bit else ends - ones
        return ends

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often a token lies in a range."""
        if token < 0 or token >> self.bits:
            return 0
        low, high = self._range(token, start, self.size if stop is None else stop)
        return int(high - low)

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of a token, ascending: select from the lowest plane up."""
        if token < 0 or token >> self.bits:
            return np.empty(0, np.int64)
        low, high = self._range(token, 0, self.size)
        at = np.arange(low, high)
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            at = self.select(level, bit, at - int(self.zeros[level]) if bit else at)
        return at

    def select(self, level: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Position of the nth (from 0) zero or one of a plane."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * SUPER - before
        block = np.searchsorted(before, nth, side="right") - 1
        left, word = nth - before[block], block * WORDS
        flip = np.uint64(0 if bit else 2**64 - 1)
        for _ in range(WORDS - 1):
            inside = np.bitwise_count(self.planes[level, word] ^ flip).astype(np.int64)
            beyond = (left >= inside) & (word % WORDS < WORDS - 1)
            left, word = np.where(beyond, left - inside, left), np.where(beyond, word + 1, word)
        chosen = (self.planes[level, word] ^ flip).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(chosen, axis=1, bitorder="little")
        return word * 64 + (np.cumsum(bits, axis=1) == (left + 1)[:, None]).argmax(axis=1)

    def tokens(self) -> np.ndarray:
        """The whole sequence: planes are un-parted from the lowest."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        out = np.zeros(self.size, kind)
        for level in reversed(range(self.bits)):
            one = np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little").view(bool)
            above, zeros = np.empty(self.size, kind), int(self.zeros[level])
            above[~one] = out[:zeros]
            above[one] = out[zeros:] | kind(1 << (self.bits - 1 - level))
            out = above
        return out


def shard_bytes(part: int, seq: int, ids: list[int | None], sizes: list[int], tokens: np.ndarray, bits: int) -> bytes:
    matrix = WaveletMatrix.build(tokens, bits)
    return b"".join(
        [
            HEAD.pack(MAGIC, part, seq, bits, len(ids), len(tokens)),
            np.array([i or 0 for i in ids], "<i8").tobytes(),
            np.array([i is None for i in ids], np.uint8).tobytes(),
            np.array(sizes, "<u8").tobytes(),
            *(a.tobytes() for a in (matrix.zeros, matrix.planes, matrix.ranks)),
        ]
    )


class Shard:
    """A file's head, documents and matrix, over the bytes as read."""

    def __init__(self, content: bytes):
        magic, self.part, self.seq, bits, docs, size = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, count, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", docs), take("u1", docs)
        self.ids = pa.array(ids, mask=null.astype(bool))
        self.sizes = take("<u8", docs).astype(np.int64)
        words, blocks = WaveletMatrix.shape(size)
        zeros = take("<u8", bits)
        planes = take("<u8", bits * words).reshape(bits, words)
        self.matrix = WaveletMatrix(size, bits, zeros, planes, take("<u4", bits * blocks).reshape(bits, blocks))


_ENCODERS: dict[int, tuple] = {}  # of this Python worker, by the tokenizer's hash


class Encoder:
    """Encodes texts; pieces between white space only once, kept for all tasks of a worker.

    A vocabulary that drops white space and lower-cases (``BY_WORD``) gives a text the
    ids of its pieces. Arrow splits the texts of a batch and numbers the different
    pieces; numpy gathers their ids. The words of a piece of Latin letters, digits and
    ASCII marks go to the model, as the characters of their bytes; other pieces go through
    the whole tokenizer. So do, whole, texts that hold an added token of the vocabulary,
    and all texts under other vocabularies. The pieces met first stay for the tasks to
    come: they are the frequent ones.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.kind = np.dtype("<u2" if self.bits <= 16 else "<u4")
        self.code = "H" if self.bits <= 16 else "I"
        self.known: dict[bytes, bytes] = {b"": b""}
        read = json.loads(spec)
        steps = [read.get("normalizer") or {}, read.get("pre_tokenizer") or {}]
        self.by_word = [s.get("normalizers") or s.get("pretokenizers") for s in steps] == BY_WORD
        self.added = [t["content"] for t in read.get("added_tokens") or ()]

    @classmethod
    def of(cls, spec: str) -> Encoder:
        key = hash(spec)
        if key not in _ENCODERS:
            _ENCODERS[key] = cls(spec)
        return _ENCODERS[key]

    def learn(self, missing: list[bytes]) -> list[bytes]:
        """Ids of pieces not met before, kept while there is room."""
        tokenize, code, out, other = self.tokenizer.model.tokenize, self.code, [], []
        for at, piece in enumerate(missing):
            if piece.isalpha():  # of ASCII letters
                ids = [t.id for t in tokenize(piece.decode())]
            elif PLAIN.fullmatch(text := piece.decode().lower()):
                ids = []
                for word in WORDS_OF.findall(text):
                    shown = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)
                    ids += [t.id for t in tokenize(shown)]
            else:
                ids = []
                other.append(at)
            out.append(array(code, ids).tobytes())
        found = self.tokenizer.encode_batch_fast([missing[at].decode() for at in other], add_special_tokens=False)
        for at, one in zip(other, found, strict=True):
            out[at] = array(code, one.ids).tobytes()
        room = max(0, CACHED_PIECES - len(self.known))
        self.known.update(itertools.islice(zip(missing, out, strict=True), room))
        return out

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, self.kind) for one in found]

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a column; a null is an empty text."""
        text = pc.fill_null(column.cast(pa.string()), "")
        if not self.by_word:
            return self.whole(text.to_pylist())
        special = np.zeros(len(text), bool)
        for token in self.added:
            special |= pc.match_substring(text, token).to_numpy(zero_copy_only=False)
        out = self._by_pieces(pc.if_else(pa.array(special), "", text) if special.any() else text)
        rows = np.flatnonzero(special).tolist()
        for row, ids in zip(rows, self.whole([text[i].as_py() for i in rows]), strict=True):
            out[row] = ids
        return out

    def _by_pieces(self, text: pa.Array) -> list[np.ndarray]:
        marked = pc.replace_substring_regex(pc.ascii_lower(text), MARK, r"\1 \2\3")
        lists = pc.ascii_split_whitespace(marked)
        pieces = lists.flatten().dictionary_encode()
        names = pieces.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        missing = [at for at, ids in enumerate(found) if ids is None]
        for at, ids in zip(missing, self.learn([names[at] for at in missing]), strict=True):
            found[at] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(found), self.kind)
        begins = np.cumsum(sizes) - sizes
        chosen = pieces.indices.to_numpy()
        lengths = sizes[chosen]
        stops = np.cumsum(lengths)
        at = np.arange(int(lengths.sum())) + np.repeat(begins[chosen] - (stops - lengths), lengths)
        ids = flat[at]
        bounds = np.concatenate([[0], stops])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [ids[a:b] for a, b in itertools.pairwise(bounds.tolist())]


def write_shards(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 2) -> None:
    """Encodes ``docs`` (doc_id, text) into shard files under ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())  # a vocabulary, a few MB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = Encoder.of(spec.value), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.kind)
        seq, held, ids, sizes, parts = 0, 0, [], [], []

        def shard() -> pa.RecordBatch:
            content = shard_bytes(part, seq, ids, sizes, np.concatenate(parts), encoder.bits)
            return pa.record_batch([pa.array([content], pa.large_binary()).cast(pa.binary())], ["value"])

        for batch in sliced(batches, BATCH_DOCS):
            all_ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for i, tokens in zip(all_ids, encoder.encode(batch.column("text")), strict=True):
                ids.append(i)
                sizes.append(len(tokens) + 1)
                parts += [tokens, end]
                held += len(tokens) + 1
                if held >= SHARD_TOKENS:
                    yield shard()
                    seq, held, ids, sizes, parts = seq + 1, 0, [], [], []
        if ids:
            yield shard()

    ordered = [F.asc_nulls_last("doc_id"), F.asc_nulls_first("text_key")]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    shards = (
        rows.repartitionByRange(*ordered)
        .sortWithinPartitions(*ordered)
        .select("doc_id", "text")
        .mapInArrow(encode, "value binary")
    )
    shards.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter("length > 1").select("content")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as u32) of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = Shard(content.as_buffer())
                tokens = shard.matrix.tokens().astype("<u4")
                stops = np.cumsum(shard.sizes)
                begins = stops - shard.sizes
                view, n = memoryview(tokens).cast("B"), len(stops)
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, shard.part)),
                        pa.array(np.full(n, shard.seq)),
                        pa.array(begins),
                        shard.ids,
                        pa.array(shard.sizes),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "seq", "begin", "doc_id", "n_tokens", "ids_crc32"],
                )

    columns = "part long, seq long, begin long, doc_id long, n_tokens long, ids_crc32 long"
    rows = stored(files(spark, path).mapInArrow(read, columns), "shard-documents")
    shards = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("size"))
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("before", F.coalesce(F.sum("size").over(in_part), F.lit(0)))
    parts = shards.groupBy("part").agg(F.sum("size").alias("part_size"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = parts.select("part", F.coalesce(F.sum("part_size").over(over), F.lit(0)).alias("offset"))
    begins = shards.join(parts, "part").select("part", "seq", (F.col("before") + F.col("offset")).alias("base"))
    return rows.join(begins, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_positions(spark: SparkSession, path: str, token: int) -> DataFrame:
    """part, seq, position: where a token lies in each shard, looked up on its planes."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = Shard(content.as_buffer())
                at = shard.matrix.occurrences(token)
                yield pa.record_batch(
                    [pa.array(np.full(len(at), shard.part)), pa.array(np.full(len(at), shard.seq)), pa.array(at)],
                    ["part", "seq", "position"],
                )

    return files(spark, path).mapInArrow(look, "part long, seq long, position long")
