r"""Secret scan with corpus-wide ownership frequency.

Base findings are three patterns, each leftmost and non-overlapping (``BASE``).
A fourth kind, ``owned``, are runs of letters, digits and ``+/_-`` of 20 characters or
more with a digit, a small and a capital letter, outside all base findings, that
only few owners and repositories have: what many hold is an example that was
copied along.

Every value is counted over the whole corpus by its 128-bit digest, by distinct
repositories (documents) and distinct owners. A value of at most ``MOST_OWNERS``
owners and ``MOST_REPOSITORIES`` distinct repositories counts as live, others as
copied; ``n_live`` and ``n_copied`` say so for all findings of a document. Rows of
the same id, owner and text are one repository here.

Scale: one pass over the texts; values alone are shuffled, once by value and
document (so none is hot) to leave repeated rows out, then counted within each task
and owner, so a value that a third of the documents hold is a few rows.

Defined cases: a null text is empty; a null owner is an owner of its own;
repeated rows are reported each; positions
count code points, the end excluded; other columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import stored

MOST_OWNERS = 2
MOST_REPOSITORIES = 10
LONG = 20  # characters in a row that an access key, a hex string or an owned value has at least
# fixed values: kind, pattern, group that holds the value, its least length
BASE = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
OWNED = re.compile(r"[A-Za-z0-9+/_-]{20,}")
KINDS = tuple(kind for kind, *_ in BASE) + ("owned",)
ROW = "doc_id long, owner string, text_key long, kinds binary, starts binary, ends binary, values binary"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """start, place of the kind, end, value of all base findings, by start and kind."""
    found = []
    long_run = max(map(len, text.split()), default=0) >= LONG
    asks = ("=" in text or ":" in text, "AKIA" in text, long_run)
    for place, ((_, pattern, group, least), ask) in enumerate(zip(BASE, asks, strict=True)):
        if ask:
            for m in pattern.finditer(text):
                if len(m[group]) >= least:
                    found.append((m.start(), place, m.end(), m[group]))
    return sorted(found)


def owned_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    if max(map(len, text.split()), default=0) < LONG:
        return []
    out = []
    for m in OWNED.finditer(text):
        v = m[0]
        mixed = any("0" <= c <= "9" for c in v) and any("a" <= c <= "z" for c in v) and any("A" <= c <= "Z" for c in v)
        if mixed and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            out.append((m.start(), len(BASE), m.end(), v))
    return out


def joined(spans) -> str:
    """kind:start:end, by start and kind, with commas between."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def candidates(docs: DataFrame) -> DataFrame:
    """A row per document with all its candidate spans, packed: columns ROW."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: tuple[list, ...] = ([], [], [], [])
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = sorted(base + owned_spans(text or "", base))
                packed[0].append(bytes(s[1] for s in spans))
                packed[1].append(np.array([s[0] for s in spans], "<i8").tobytes())
                packed[2].append(np.array([s[2] for s in spans], "<i8").tobytes())
                packed[3].append(b"".join(xxhash.xxh3_128_digest(s[3]) for s in spans))
            yield pa.record_batch(
                [batch.column(c) for c in ("doc_id", "owner", "text_key")] + [pa.array(p, pa.binary()) for p in packed],
                ["doc_id", "owner", "text_key", "kinds", "starts", "ends", "values"],
            )

    return docs.mapInArrow(find, ROW)


def document_values(rows: DataFrame) -> DataFrame:
    """doc_id, owner, text_key, v1, v2: the distinct values of each row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [np.unique(np.frombuffer(v, "<i8").reshape(-1, 2), axis=0) for v in batch.column("values").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(pairs)), [len(p) for p in pairs]))
            values = np.concatenate([np.empty((0, 2), np.int64), *pairs])
            yield pa.record_batch(
                [batch.column(c).take(at) for c in ("doc_id", "owner", "text_key")]
                + [pa.array(values[:, 0]), pa.array(values[:, 1])],
                ["doc_id", "owner", "text_key", "v1", "v2"],
            )

    return rows.select("doc_id", "owner", "text_key", "values").mapInArrow(
        each, "doc_id long, owner string, text_key long, v1 long, v2 long"
    )


def ownership(values: DataFrame) -> DataFrame:
    """v1, v2, repositories, owners: of every candidate value in the corpus."""
    distinct = values.select("v1", "v2", "owner", "doc_id", "text_key").distinct()
    by_owner = distinct.groupBy("v1", "v2", "owner").agg(F.count("*").alias("held"))
    return by_owner.groupBy("v1", "v2").agg(F.sum("held").alias("repositories"), F.count("*").alias("owners"))


def scan(
    docs: DataFrame,
    owner: str = "source",
    most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, owners, repositories per document.

    ``owners`` and ``repositories`` are the counts of the values of ``spans``, in their order.
    """
    rows = docs.select("doc_id", "text", F.col(owner).cast("string").alias("owner"), F.xxhash64("text").alias("text_key"))
    rows = stored(candidates(rows), "secret-spans")
    values = document_values(rows.filter(F.length("kinds") > 0))
    counts = stored(ownership(values), "secret-values")
    ids = ["doc_id", "owner", "text_key"]
    known = F.collect_set(F.struct("v1", "v2", "owners", "repositories")).alias("counts")
    marked = values.join(counts, ["v1", "v2"]).groupBy(*ids).agg(known)
    a, b = rows.alias("a"), marked.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ids]
    whole = a.join(b, same[0] & same[1] & same[2], "left").select("a.doc_id", "kinds", "starts", "ends", "values", "counts")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("kinds", "starts", "ends", "values", "counts"))
            for kinds, starts, ends, values, held in zip(*columns, strict=True):
                found = {np.array([v["v1"], v["v2"]], "<i8").tobytes(): (v["owners"], v["repositories"]) for v in held or ()}
                spans = zip(np.frombuffer(starts, "<i8").tolist(), kinds, np.frombuffer(ends, "<i8").tolist(), strict=True)
                base, shown, n_live, n_copied = [], [], 0, 0
                for i, span in enumerate(spans):
                    owners, repositories = found[values[16 * i : 16 * i + 16]]
                    is_live = owners <= most_owners and repositories <= most_repositories
                    if span[1] < len(BASE):
                        base.append(span)
                    if span[1] < len(BASE) or is_live:
                        shown.append((*span, owners, repositories))
                    n_live += is_live
                    n_copied += not is_live
                shown.sort()
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                counts = [sum(s[1] == k for s in base) for k in range(len(BASE))]
                held = (",".join(str(s[i]) for s in shown) for i in (3, 4))
                out.append((*counts, digest, joined(s[:3] for s in shown), n_live, n_copied, *held))
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied", "owners", "repositories"]
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.string()] * 2
            made = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch([batch.column("doc_id"), *made], ["doc_id", *names])

    return whole.mapInArrow(
        report,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_live long, n_copied long, "
        "owners string, repositories string",
    )
