"""Substring dedup, line dedup and Jaccard join against brute force."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenantlens.llm import line_dedup, ngram_jaccard, substring_dedup
from tenantlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(None, None), (7, None), (8, ""), (9, " \t\n"), (10, "one"), (10, "one"), (10, "other")]


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def removed_by_brute_force(docs, window):
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "seed"), [(6, 3), (10, 4), (50, 12)])
def test_substring_dedup_equals_brute_force(make, prose, window, seed):
    texts = prose(window, 120, 4 * window, 60 if window < 50 else 400)
    texts += [" ".join(["same"] * 3 * window)] * 3  # one word over and over
    docs = list(enumerate(texts))
    result = substring_dedup.remove_repeats(make(*docs), window, seed)
    assert collected(result, "doc_id", "n_words", "n_removed", "kept_text") == removed_by_brute_force(docs, window)
    for row in result.collect():
        assert sum(b - a for a, b in row["removed_spans"]) == row["n_removed"]


def test_substring_dedup_defined_cases(make, spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = [*ODD, (1, long), (2, "x " + long), (3, long), (3, long), (None, long)]
    result = {}
    for row in substring_dedup.remove_repeats(make(*docs), 50).collect():
        result.setdefault(row["doc_id"], []).append((row["n_words"], row["n_removed"]))
    assert result[1] == [(30_000, 0)] and result[2] == [(30_001, 30_000)]
    assert result[3] == [(30_000, 30_000)] * 2
    assert sorted(result[None]) == [(0, 0), (30_000, 30_000)]
    assert result[10] == [(1, 0)] * 3 and result[8] == [(0, 0)]
    assert substring_dedup.remove_repeats(make().limit(0), 50).count() == 0


def lines_by_brute_force(docs, least):
    held = {}
    for n, (_, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            held.setdefault(line_dedup.key_of(line.encode()), set()).add(n)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        keys = [line_dedup.key_of(x.encode()) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if not k or len(held[k]) < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_equals_brute_force(make, prose):
    rng = np.random.default_rng(5)
    common = [f"Common line {k}" for k in range(30)]
    docs = [*ODD]
    for i, text in enumerate(prose(3, 60)):
        own = [c if rng.random() < 0.5 else f"\t{c.upper()} \r" for c in common if rng.random() < 0.25]
        docs.append((i + 100, "\n".join([*own, text, "ÄÖ", "äö"])))
    docs.append((500, "\n".join(f"l{i}" for i in range(50_000)) + "\n" + common[0]))
    result = line_dedup.drop_lines(make(*docs), 10)
    assert collected(result, "doc_id", "n_lines", "n_dropped", "kept_text") == lines_by_brute_force(docs, 10)
    assert line_dedup.drop_lines(make().limit(0), 10).count() == 0


def test_line_index_is_reversible(make):
    def docs(start, count, shared):
        return [(i, f"only {i}\nall\nhalf {i % 2}\n{shared}") for i in range(start, start + count)]

    first, more = make(*docs(0, 12, "early")), make(*docs(100, 30, "late"))
    before = line_dedup.reference_counts(line_dedup.document_keys(first))
    both = line_dedup.changed_counts(before, more, None)
    after = line_dedup.changed_counts(both, None, more)
    assert collected(after, "k1", "k2", "refs") == collected(before, "k1", "k2", "refs")
    filters = line_dedup.build_filters(before, 10, 2)
    grown = line_dedup.updated_filters(filters, before, both, 10, 2)
    back = line_dedup.updated_filters(grown, both, after, 10, 2)

    def hits(index):
        asked = line_dedup.document_keys(first.unionByName(more))
        return collected(line_dedup.maybe_frequent(asked, index, 2).select("k1", "k2").distinct(), "k1", "k2")

    frequent = {(r["k1"], r["k2"]) for r in both.filter("refs >= 10").collect()}
    assert frequent <= set(hits(grown)) and len(hits(grown)) <= len(frequent) + 2
    assert hits(back) == hits(filters)


def test_cuckoo_filter_holds_loses_and_grows():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, (50_000, 2))
    k1, k2 = keys[:, 0].copy(), keys[:, 1].copy()
    index = line_dedup.CuckooFilter.holding(k1[:40_000], k2[:40_000])
    assert index.contains(k1[:40_000], k2[:40_000]).all()
    assert index.contains(k1[40_000:], k2[40_000:]).mean() < 0.01
    index.delete(k1[:20_000], k2[:20_000])
    assert index.contains(k1[20_000:40_000], k2[20_000:40_000]).all()
    assert index.contains(k1[:20_000], k2[:20_000]).mean() < 0.01


def test_filters_grow_a_hundredfold(make):
    """A filter built for a few keys is built anew where many more have come; and back."""
    def lines(start, count):
        return "\n".join(f"line {k}" for k in range(start, start + count))

    few, many = make(*[(i, lines(0, 3)) for i in range(10)]), make(*[(i, lines(100, 400)) for i in range(10)])
    before = line_dedup.reference_counts(line_dedup.document_keys(few))
    after = line_dedup.changed_counts(before, many, None)
    filters = line_dedup.build_filters(before, 10, 2)
    grown = line_dedup.updated_filters(filters, before, after, 10, 2)

    def hits(index):
        asked = line_dedup.document_keys(few.unionByName(many))
        return line_dedup.maybe_frequent(asked, index, 2).select("k1", "k2").distinct().count()

    assert hits(filters) <= 6 and hits(grown) == 403
    assert hits(line_dedup.updated_filters(grown, after, before, 10, 2)) <= 6


def test_lines_of_many_rows_without_an_id(spark):
    """A third and more of the rows have no id or one id: none of them gets the others' keys."""
    text = F.concat_ws("\n", F.lit("Common"), F.concat(F.lit("own "), "id"), F.concat(F.lit("shared "), F.col("id") % 500))
    who = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id"))
    docs = spark.range(0, 30_000, 1, 8).select(who.alias("doc_id"), text.alias("text"))
    kept = line_dedup.drop_lines(docs)
    assert {(r["n_dropped"], r["count"]) for r in kept.groupBy("n_dropped").count().collect()} == {(2, 30_000)}
    assert kept.filter(~F.col("kept_text").startswith("own ")).count() == 0
    keys = line_dedup.document_keys(docs)
    assert keys.select("rank", "text_key").distinct().count() == 30_000


def one_cluster(size, changed, words=200, seed=1):
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(words)]
    out = []
    for i in range(size):
        own = list(base)
        for at in rng.choice(words, changed, replace=False):
            own[at] = f"x{i}y{at}"
        out.append((i, " ".join(own)))
    return out


def test_pairs_of_a_loose_cluster_stay_few(make, monkeypatch):
    """Texts that are 0.6 to 0.75 alike share many prefix shingles; bitmaps rule them out."""
    seen = []
    real = ngram_jaccard.missing_pairs
    monkeypatch.setattr(ngram_jaccard, "missing_pairs", lambda *a: seen.append(real(*a).count()) or real(*a))
    docs = one_cluster(300, 4)
    result = ngram_jaccard.jaccard_classes(make(*docs), 5, 80)
    assert collected(result, "doc_id", "n_shingles", "component_id") == classes_by_brute_force(docs, 5, 80)
    assert max(seen) < 300 * 299 / 2 / 20


def test_long_texts_are_verified_only_if_wide_bitmaps_are_alike(make, monkeypatch):
    """Sets of 4,000 shingles that are 0.65 alike: the bitmaps of the lists are too narrow to tell."""
    seen = []
    real = ngram_jaccard.verified
    monkeypatch.setattr(ngram_jaccard, "verified", lambda p, *a: seen.append(p.count()) or real(p, *a))
    docs = one_cluster(24, 80, words=4000)
    docs.append((100, docs[7][1] + " one more"))
    result = ngram_jaccard.jaccard_classes(make(*docs), 5, 80)
    assert collected(result, "doc_id", "n_shingles", "component_id") == classes_by_brute_force(docs, 5, 80)
    assert 1 <= max(seen) <= 24


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(6)
    for size in (1, 40, 255, 256, 257, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: size * 4 // 5], rng.integers(0, 2**63, size // 3).astype(np.uint64)]))
        bits = np.array([ngram_jaccard.parity(a), ngram_jaccard.parity(b)], object)
        width = min(map(len, bits))
        one, two = (ngram_jaccard._bitmaps(bits, np.array([k]), width)[0] for k in (0, 1))
        assert np.bitwise_count(one ^ two).sum() <= len(np.setxor1d(a, b))


def classes_by_brute_force(docs, n, percent):
    sets = []
    for _, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        k = min(n, len(words))
        sets.append({tuple(words[p : p + k]) for p in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least.setdefault(root(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [x for x in least[root(i)] if x is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def test_groups_of_equal_prefix_are_expanded(make, monkeypatch):
    """Sets of equal size that differ behind their prefixes only: the heavy shingles, which come last."""
    monkeypatch.setattr(ngram_jaccard, "LOCAL_DOCS", 1)
    docs = []
    for i in range(48):
        own = [f"rare{i // 4}x{k}" for k in range(12)]
        docs.append((i, " ".join(own + [f"common{((0, 1, 12, 13)[i % 4] + k) % 40}" for k in range(30)])))
    seen = []
    real = ngram_jaccard.group_members
    monkeypatch.setattr(ngram_jaccard, "group_members", lambda e: seen.append(real(e).count()) or real(e))
    for percent in (75, 80):
        result = ngram_jaccard.jaccard_classes(make(*docs), 1, percent)
        assert collected(result, "doc_id", "n_shingles", "component_id") == classes_by_brute_force(docs, 1, percent)
    assert min(seen) >= 12


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (2, 60), (1, 80)])
def test_jaccard_classes_equal_brute_force(make, prose, n, percent):
    docs = list(enumerate(prose(n, 150, 150)))
    docs += [(None, None), (1001, None), (1002, ""), (1003, "A b"), (1004, "a B"), (None, docs[5][1]), (None, "alone at last")]
    docs += [(2000 + i, " ".join(f"p{k}" for k in range(60)) + f" end {i}") for i in range(40)]  # near copies
    docs += [(3000 + i, f"start {i} " + " ".join(f"q{k}" for k in range(30)) + " " + " ".join(f"r{i}x{k}" for k in range(60))) for i in range(40)]
    result = ngram_jaccard.jaccard_classes(make(*docs), n, percent)
    assert collected(result, "doc_id", "n_shingles", "component_id") == classes_by_brute_force(docs, n, percent)


def links_by_brute_force(docs, n, percent):
    sets = []
    for _, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        k = min(n, len(words))
        sets.append({tuple(words[p : p + k]) for p in range(len(words) - k + 1)} if words else set())
    count = [0] * len(docs)
    for i, j in itertools.combinations(range(len(docs)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            count[i] += 1
            count[j] += 1
    return sorted(((d[0], c) for d, c in zip(docs, count, strict=True)), key=str)


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (1, 75)])
def test_all_links_inside_components_are_counted(make, prose, monkeypatch, n, percent):
    monkeypatch.setattr(ngram_jaccard, "LOCAL_DOCS", 1)
    docs = list(enumerate(prose(n, 60, 150))) + [(None, None), (1002, ""), (None, "alone at last")]
    docs += [(2000 + i, " ".join(f"p{k}" for k in range(60)) + f" end {i // 2}") for i in range(30)]
    for i in range(24):
        own = [f"rare{i // 4}x{k}" for k in range(12)]
        docs.append((3000 + i, " ".join(own + [f"common{((0, 1, 12, 13)[i % 4] + k) % 40}" for k in range(30)])))
    found = ngram_jaccard.jaccard_links(make(*docs), n, percent)
    assert collected(found, "doc_id", "n_links") == links_by_brute_force(docs, n, percent)


def test_different_texts_of_one_id_are_documents_of_their_own(make):
    base = [f"w{k}" for k in range(48)]
    docs = [(1, " ".join(base[:40])), (1, " ".join(f"u{k}" for k in range(47)) + " w44"), (2, " ".join(base)), (0, "one here"), (3, "ONE here"), (3, "clean text of a repeated id")]
    result = ngram_jaccard.jaccard_classes(make(*docs), 1, 80)
    assert collected(result, "doc_id", "n_shingles", "component_id") == classes_by_brute_force(docs, 1, 80)
    kept = ngram_jaccard.one_of_each(make(*docs), 1, 80)
    assert collected(kept, "doc_id", "text") == sorted([docs[0], docs[1], docs[3], docs[5]], key=str)


def test_one_of_each_component_stays(make, prose):
    docs = list(enumerate(prose(9, 60, 120))) + [(500, "same id"), (500, "same id"), (None, "no id here"), (600, None)]
    kept = ngram_jaccard.one_of_each(make(*docs))
    assert kept.columns == make().columns
    expected = {c for i, _, c in classes_by_brute_force(docs, 5, 80) if i is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(expected)
    assert kept.filter("doc_id IS NULL").count() == 1
    empty = make().limit(0)
    assert ngram_jaccard.one_of_each(empty).count() == 0
    assert ngram_jaccard.jaccard_classes(empty).count() == 0


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 200)] + [(2000, 2000), (5, 5)]
    edges = spark.createDataFrame(chain + hub, "a BIGINT, b BIGINT")
    found = dict(collected(components(edges), "node", "component"))
    assert {found[i] for i in range(301)} == {0} and {found[1000 + i] for i in range(200)} == {1000}
    assert components(edges.limit(0)).count() == 0


def test_hashes_tell_sets_apart():
    digests = {ngram_jaccard.set_digest(np.array(s, np.uint64)) for s in ([1, 2], [2, 1], [1], [], [3])}
    assert len(digests) == 4
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_batches_of_texts_are_bounded_by_bytes(spark):
    """A worker gets about a slice of texts at once, however many rows a batch may have."""
    import pyarrow as pa

    from tenantlens.llm.common import MOST_BATCH_BYTES, sliced

    def sizes(batches):
        for batch in batches:
            parts = [s.num_rows for s in sliced(iter([batch]))]
            yield pa.record_batch([pa.array([batch.nbytes]), pa.array([min(parts)]), pa.array([sum(parts)])], ["bytes", "least", "rows"])

    rows = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    found = rows.mapInArrow(sizes, "bytes long, least long, rows long").collect()
    assert max(r["bytes"] for r in found) < 1.1 * MOST_BATCH_BYTES
    assert sum(r["rows"] for r in found) == 9000
    assert sorted(r["least"] for r in found)[1] > 1000  # only the last batch may be small
