r"""SentencePiece encoding and decoding for vocabularies of the merge type (BPE).

*Encoding.* The normalized text is a row of symbols, one per character (a piece that
the user defined stands whole and takes no part). An agenda holds the adjacent pairs
whose union is a piece, by score, then by place; the best is merged, its new
neighbours join the agenda, and entries that a merge has overtaken are left out when
they come up. What is left is pieces, and with byte fallback the bytes of characters
that no piece has.

Short texts have their agendas side by side as rows of arrays (``many_ids``), long ones
a heap.

*Segments.* Two neighbouring characters can come together only if some piece has them
side by side. Characters that do so are of one class (letters mostly are one, marks
and digits others); unless a piece has a space behind another character, merges stay
inside a stretch of one class with the spaces before it. Such segments are encoded
each for itself, and frequent ones are kept.

*Decoding* turns pieces and runs of byte pieces back to text.

*Check.* In each Arrow batch the library encodes what is new: the segments not met
before, as one text; texts with pieces that the user defined, and all texts of a
vocabulary without segments, whole. It decodes all ids. A difference stops the job (``check=False`` leaves that out). Normalization is the library's.

Scale: one pass, no shuffle. A task holds a slice of a batch; an agenda is as long as
its segment. The model file is sent with the job.

Defined cases: a null or empty text has no ids; rows with one id or text are each their
own; very long texts and segments take time in proportion to their length (times its
logarithm); an empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

import contextlib
import functools
import heapq
import itertools
import pathlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_format

from tenantlens.llm.common import sliced

SPACE = "▁"
APART = "\n"  # between segments that are checked
KEPT_SEGMENTS = 300_000
SHORT = (6, 10, 16, 32, 64)  # characters of the segments whose agendas lie side by side
ROWS = 20_000  # agendas side by side
NONE = float("-inf")
SLICE_ROWS = 500
BPE = model_format.TrainerSpec.BPE


class PieceCodec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        spec = model_format.ModelProto.FromString(model)
        if spec.trainer_spec.model_type != BPE:
            raise ValueError("the agenda is for vocabularies of the merge type")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        kinds = model_format.ModelProto.SentencePiece
        self.pieces = [p.piece for p in spec.pieces]
        self.kinds = [p.type for p in spec.pieces]
        mergeable = (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)
        self.scores = {p.piece: p.score for p in spec.pieces if p.type in mergeable}
        self.unused = {p.piece for p in spec.pieces if p.type == kinds.UNUSED}
        self.id_of = {p.piece: i for i, p in enumerate(spec.pieces) if p.type in mergeable}
        # control, unknown and byte pieces come first when a piece is looked up
        self.id_of |= {p.piece: i for i, p in enumerate(spec.pieces) if p.type not in mergeable}
        self.unknown = self.kinds.index(kinds.UNKNOWN)
        self.byte_id = [self.id_of.get(f"<0x{b:02X}>", self.unknown) for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_id) if self.kinds[i] == kinds.BYTE}
        self.control = {i for i, k in enumerate(self.kinds) if k == kinds.CONTROL}
        self.byte_fallback = spec.trainer_spec.byte_fallback
        self.unknown_text = spec.trainer_spec.unk_surface
        self.leading = spec.normalizer_spec.add_dummy_prefix or spec.normalizer_spec.remove_extra_whitespaces
        self.dummy = spec.normalizer_spec.add_dummy_prefix
        self.all_leading = spec.normalizer_spec.remove_extra_whitespaces
        own = sorted((p.piece for p in spec.pieces if p.type == kinds.USER_DEFINED), key=len, reverse=True)
        self.own = re.compile("(" + "|".join(map(re.escape, own)) + ")") if own else None
        self.crossing = any(re.search(f"[^{SPACE}]{SPACE}|{APART}", p) for p in self.scores)
        self.segment = re.compile("(?s).+" if self.crossing else self._segments())
        # ids whose text does not depend on others
        self.plain = {i: p.replace(SPACE, " ") for p, i in self.id_of.items() if p in self.scores and i not in self.byte_of}
        self.plain |= {i: chr(b) for i, b in self.byte_of.items() if b < 128}
        self.characters = np.arange(0x110000) + len(self.pieces)
        for piece in self.scores:
            if len(piece) == 1:
                self.characters[ord(piece)] = self.id_of[piece]
        self.pair_keys, self.pair_unions = self._pairs()
        self.pair_scores = np.array([self.scores[self.pieces[i]] for i in self.pair_unions])
        self.kept: dict[str, list[int]] = {}

    def _segments(self) -> str:
        """Pattern of the stretches that no merge leaves. Characters that follow each other
        in some piece are of one class; a piece lies in one class but for its spaces."""
        root: dict[str, str] = {}

        def top(x: str) -> str:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for piece in self.scores:
            for a, b in itertools.pairwise(piece.lstrip(SPACE)):
                root[top(a)] = top(b)
            if piece[:1] == SPACE and (rest := piece.lstrip(SPACE)):
                top(rest[0])
        classes: dict[str, list[str]] = {}
        for x in root:
            classes.setdefault(top(x), []).append(x)
        inside = [f"[{re.escape(''.join(sorted(c)))}]+" for c in sorted(classes.values(), key=len, reverse=True)]
        alone = f"[^{re.escape(''.join(sorted(root)))}{SPACE}]"
        return f"(?s){SPACE}*(?:{'|'.join([*inside, alone])})|{SPACE}+"

    def merged(self, text: str) -> list[str]:
        """Symbols of a text after all merges."""
        symbols: list[str] = list(text)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, made, agenda = self.scores, {}, []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and (score := scores.get(union := symbols[a] + symbols[b])) is not None:
                heapq.heappush(agenda, (-score, a, b, union))
                if union in self.unused:
                    made[union] = (symbols[a], symbols[b])

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, a, b, union = heapq.heappop(agenda)
            if not symbols[a] or not symbols[b] or len(symbols[a]) + len(symbols[b]) != len(union):
                continue  # a merge has changed one of them
            symbols[a], symbols[b] = union, ""
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        whole = [s for s in symbols if s]
        return [part for s in whole for part in self._split(s, made)] if made else whole

    def _split(self, symbol: str, made: dict[str, tuple[str, str]]) -> Iterator[str]:
        """A piece that is marked unused falls back to what it was made of."""
        if symbol in self.unused and symbol in made:
            for part in made[symbol]:
                yield from self._split(part, made)
        else:
            yield symbol

    def _ids(self, symbol: str) -> list[int]:
        found = self.id_of.get(symbol, self.unknown)
        if found == self.unknown and self.byte_fallback:
            return [self.byte_id[b] for b in symbol.encode()]
        return [found]

    def segment_ids(self, segment: str) -> list[int]:
        return [i for symbol in self.merged(segment) for i in self._ids(symbol)]

    def _symbol(self, text: str) -> int:
        """Number of a symbol of the agenda: its piece, or a character that is none."""
        return self.id_of[text] if text in self.scores else len(self.pieces) + ord(text)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pairs of symbols whose union is a piece, sorted, and these pieces."""
        base, keys, unions = len(self.pieces) + 0x110000, [], []
        for piece in self.scores:
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if all(len(x) == 1 or x in self.scores for x in (a, b)):
                    keys.append(self._symbol(a) * base + self._symbol(b))
                    unions.append(self.id_of[piece])
        order = np.argsort(np.array(keys, np.int64))
        return np.array(keys, np.int64)[order], np.array(unions, np.int64)[order]

    def many_ids(self, segments: list[str]) -> list[list[int]]:
        """Ids of each segment. Short ones have their agendas side by side, one a row:
        each round merges the best pair of every row, the first of equal ones."""
        out: list[list[int]] = [[]] * len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        bounds = [0, *SHORT] if not self.unused else [0]
        for low, high in itertools.pairwise(bounds):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            for at in range(0, len(rows), ROWS):
                some = rows[at : at + ROWS]
                for row, ids in zip(some.tolist(), self._rows([segments[i] for i in some], high), strict=True):
                    out[row] = ids
        for row in np.flatnonzero(lengths > bounds[-1]).tolist():
            out[row] = self.segment_ids(segments[row])
        return out

    def _rows(self, segments: list[str], width: int) -> list[list[int]]:
        n, base = len(segments), len(self.pieces) + 0x110000
        points = np.array("".join(x.ljust(width, "\0") for x in segments)).reshape(1).view(np.uint32) if n else np.empty(0)
        lengths = np.fromiter(map(len, segments), np.int64, n)
        symbols = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width)[None, :] < lengths[:, None]
        symbols[:, :width][inside] = self.characters[points.reshape(n, width)[inside]]
        following = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))

        def offered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Score and union of pairs; no piece has the least score."""
            keys = np.where((a < 0) | (b < 0), -1, a * base + b)
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            found = self.pair_keys[at] == keys
            return np.where(found, self.pair_scores[at], NONE), self.pair_unions[at]

        agenda, unions = offered(symbols[:, :-1], symbols[:, 1:])
        active = np.arange(n)
        while len(active):
            best = agenda[active].argmax(axis=1)
            going = agenda[active, best] > NONE
            active, i = active[going], best[going]
            j = following[active, i]
            k = following[active, j]
            symbols[active, i] = unions[active, i]
            symbols[active, j] = -1
            agenda[active, j % width] = np.where(j < width, NONE, agenda[active, j % width])
            following[active, i] = k
            before[active, np.minimum(k, width)] = np.where(k <= width, i, before[active, np.minimum(k, width)])
            after = np.where(k <= width, symbols[active, np.minimum(k, width)], -1)
            agenda[active, i], unions[active, i] = offered(symbols[active, i], after)
            h = before[active, i]
            some = h >= 0
            rows, h, i = active[some], h[some], i[some]
            agenda[rows, h], unions[rows, h] = offered(symbols[rows, h], symbols[rows, i])
        left = symbols >= 0
        flat, ends = symbols[left].tolist(), [0, *left.sum(axis=1).cumsum().tolist()]
        out = [flat[a:b] for a, b in itertools.pairwise(ends)]
        odd = np.flatnonzero(((symbols >= len(self.pieces)) & left).any(axis=1)).tolist()
        for row in odd:  # characters that no piece has
            out[row] = [i for x in out[row] for i in ([x] if x < len(self.pieces) else self._ids(chr(x - len(self.pieces))))]
        return out

    def encode(self, texts: list[str], check: bool = False) -> list[list[int]]:
        """Ids of each text. ``check``: each segment is checked when it is first met, and
        texts that segments do not tell, as a whole."""
        parts, whole = [], []
        fresh: dict[str, list[int]] = {}
        for at, text in enumerate(texts):
            normal = self.library.normalize(text)
            pieces = self.own.split(normal) if self.own else [normal]
            found = []  # of each stretch between pieces that the user defined: segments, ids known
            for n, piece in enumerate(pieces):
                segments = [piece] if n % 2 else self.segment.findall(piece)
                known = [[self.id_of[piece]]] if n % 2 else list(map(self.kept.get, segments))
                if None in known:
                    fresh.update((s, ()) for s, ids in zip(segments, known, strict=True) if ids is None)
                found.append((segments, known))
            parts.append(found)
            if check and len(pieces) > 1:
                whole.append(at)
        names = list(fresh)
        fresh = dict(zip(names, self.many_ids(names), strict=True))
        if check and (self.crossing or not self._checked(fresh)):
            whole = range(len(texts))
        room = KEPT_SEGMENTS - len(self.kept)
        self.kept.update(itertools.islice(((s, i) for s, i in fresh.items() if len(s) <= SHORT[-1]), max(0, room)))
        out = []
        for found in parts:
            ids: list[int] = []
            for segments, known in found:
                if None in known:
                    known = [fresh[s] if i is None else i for s, i in zip(segments, known, strict=True)]
                ids.extend(itertools.chain.from_iterable(known))
            out.append(ids if self.byte_fallback else _one_unknown(ids, self.unknown))
        if whole and [out[i] for i in whole] != self.library.encode([texts[i] for i in whole], num_threads=1):
            raise ValueError("ids differ from the sentencepiece library")
        return out

    def _checked(self, fresh: dict[str, list[int]]) -> bool:
        """New segments against the library, as one text with a character between them that
        no piece has; False if the library would not leave that text as it is."""
        text = "".join(APART + s for s in fresh)
        if self.library.normalize(text.replace(SPACE, " ")) != SPACE * self.dummy + text:
            return False
        apart, ids = self._ids(APART), self._ids(SPACE) if self.dummy and text else []
        for found in fresh.values():
            ids += apart
            ids += found
        ids = ids if self.byte_fallback else _one_unknown(ids, self.unknown)
        if ids != self.library.encode(text.replace(SPACE, " ")):
            raise ValueError("ids differ from the sentencepiece library")
        return True

    def decode(self, ids: list[int]) -> str:
        if not self.all_leading:
            with contextlib.suppress(KeyError):
                text = "".join(map(self.plain.__getitem__, ids))
                led = self.leading and ids and self.pieces[ids[0]].startswith(SPACE)
                return text[1:] if led else text
        out, run, first = [], bytearray(), True
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_characters(bytes(run)))
                run, first = bytearray(), False
            if i in self.control:
                continue
            piece = self.unknown_text if i == self.unknown else self.pieces[i]
            if first and self.leading and i != self.unknown:
                cut = piece.lstrip(SPACE) if self.all_leading else piece.removeprefix(SPACE)
                first = self.all_leading and not cut
                piece = cut
            else:
                first = False
            out.append(piece.replace(SPACE, " "))
        return "".join(out) + _characters(bytes(run))


def _one_unknown(ids: list[int], unknown: int) -> list[int]:
    """Neighbouring unknown symbols are one."""
    return [x for i, x in enumerate(ids) if x != unknown or not i or ids[i - 1] != x]


def _characters(run: bytes) -> str:
    """Text of byte pieces; each byte that belongs to no character is U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError as error:
        good = run[: error.start].decode()
        return good + "�" + _characters(run[error.start + 1 :])


@functools.lru_cache(maxsize=1)
def _codec(model: bytes) -> PieceCodec:
    """Kept by a Python worker from task to task."""
    return PieceCodec(model)


CODED = "doc_id long, ids array<int>, decoded string"


def coded(docs: DataFrame, model_file: str, check: bool = True) -> DataFrame:
    """doc_id, ids, decoded: the ids of each whole text, and the text they decode to."""
    model = pathlib.Path(model_file).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a file of a megabyte or so
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in sliced(batches, SLICE_ROWS):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = codec.encode(texts, check)
            decoded = [codec.decode(i) for i in ids]
            if check and decoded != codec.library.decode(ids, num_threads=1):
                raise ValueError("decoded text differs from the sentencepiece library")
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), pa.array(ids, schema.field("ids").type), pa.array(decoded)],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(each, CODED)
