"""Decontamination, secrets, languages and licenses against brute force and held-out rows."""

import hashlib
import random
import re

import pytest

from tenantlens.llm import decontamination, language_id, license_scan, secret_scan

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def contained_by_brute_force(docs, items, n=5, percent=80):
    out = []
    for item_id, text in items:
        words = WORD.findall((text or "").encode().lower())
        k = min(n, len(words))
        if not words:
            continue
        own = {tuple(words[p : p + k]) for p in range(len(words) - k + 1)}
        for doc_id, doc in docs:
            other = WORD.findall((doc or "").encode().lower())
            there = {tuple(other[p : p + k]) for p in range(len(other) - k + 1)}
            common = len(own & there)
            if 100 * common >= percent * len(own) and common:
                out.append((doc_id, item_id, len(own), common))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [2_000_000, 60])
def test_leaks_equal_brute_force(spark, make, prose, monkeypatch, block_words):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    rng = random.Random(4)
    texts = prose(21, 80, 200)
    items = [(k, " ".join(f"t{rng.randrange(300)}" for _ in range(rng.randint(1, 30)))) for k in range(40)]
    items += [(50, None), (51, ""), (52, "Three little words"), (53, items[9][1]), (None, "x y z")]
    for k, item in items[:30]:
        words = item.split()
        if k % 3 == 0 and len(words) > 8:
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(["before", *words, "after"]).upper())
    items += [(None, "no id of its own"), (54, "many times the same")] + [(60 + k, "many times the same") for k in range(30)]
    docs = list(enumerate(texts)) + [(None, None), (900, ""), (901, "a three LITTLE words b"), (901, items[9][1])]
    docs += [(902, "here is no id of its own"), (904, "many times the same"), (903, "so " * 200_000 + "three little words")]
    table = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = decontamination.leaks(make(*docs), table)
    assert sorted(((r["doc_id"], r["item_id"], r["n_item"], r["n_common"]) for r in found.collect()), key=str) == contained_by_brute_force(docs, items)
    clean = decontamination.without_leaks(make(*docs), table)
    bad = {m[0] for m in contained_by_brute_force(docs, items)}
    assert clean.columns == make().columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted((d[0] for d in docs if d[0] not in bad), key=str)
    assert decontamination.leaks(make().limit(0), table).count() == 0
    assert decontamination.leaks(make(*docs), table.limit(0)).count() == 0


def spans_by_brute_force(text):
    assign = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets_keep_base_spans_and_tell_copied_from_live(make):
    rng = random.Random(2)
    pieces = ["password", "Secret", "token", "API_KEY", "apikey", "=", ":", " = ", '"', "'", "abc", "x1y2z3", "\n", "é"]
    pieces += ["AKIA", "ABCDEFGH23456789", "deadbeef" * 3, "0123456789abcdef", ".", " "]
    docs = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))), None, f"s{i % 4}") for i in range(300)]
    live, copied = "Zx9" + "aB3dE5fG7hJ9kL1mN3", "Qw7" + "pQ2rS4tU6vW8xY0zA2"
    docs += [(1000, f"see {live} here", None, "s1"), (1001, None, None, None), (1002, "", None, None)]
    docs += [(1100 + i, f"é {copied}", None, f"owner{i}") for i in range(5)]
    docs += [(1200, f"token = {live}", None, "s1"), (1200, f"token = {live}", None, "s1")]
    result = {}
    for r in secret_scan.scan(make(*docs)).collect():
        result.setdefault(r["doc_id"], []).append(r)
    for doc_id, text, *_ in docs:
        base = spans_by_brute_force(text or "")
        for r in result[doc_id]:
            joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
            assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
            assert set(joined.split(",")) <= set(r["spans"].split(",")) | {""}
    assert result[1000][0]["spans"] == "owned:4:25" and result[1000][0]["n_live"] == 1
    assert result[1100][0]["spans"] == "" and result[1100][0]["n_copied"] == 1
    assert len(result[1200]) == 2
    assert secret_scan.scan(make().limit(0)).count() == 0


def test_values_copied_through_documents_of_one_owner_are_not_live(make):
    copied, lost, live = "Qw7pQ2rS4tU6vW8xY0zA2", "Er5pQ2rS4tU6vW8xY0zB3", "Zx9aB3dE5fG7hJ9kL1mN3"
    docs = [(i, f"see {copied} in {i}", None, "hot") for i in range(40)] + [(100 + i, f"see {lost}", None, None) for i in range(40)]
    docs += [(200 + i, f"see {live} in {i}", None, "hot") for i in range(3)] + [(300, f"see {live}", None, "hot")] * 40
    for r in secret_scan.scan(make(*docs)).collect():
        alive = r["doc_id"] >= 200
        assert (r["n_live"], r["n_copied"], r["spans"]) == ((1, 0, "owned:4:25") if alive else (0, 1, ""))
        assert (r["owners"], r["repositories"]) == (("1", "4") if alive else ("", ""))


SYLLABLES = {"aa": "ka lo mi nu pe".split(), "bb": "str und sch ein".split(), "cc": "ção ér où ñan".split()}


def sentences(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages_of_held_out_documents(make):
    rng = random.Random(8)
    docs = [(i, sentences(rng, lang, rng.randint(8, 60)) + " 12 !!", lang) for i in range(900) for lang in [rng.choice(list(SYLLABLES))]]
    odd = [(5000, None, "aa"), (5001, "", "aa"), (5002, "123 !?", "bb"), (None, docs[0][1], "aa"), (5003, docs[1][1], None), (5003, docs[1][1], None)]
    rows = language_id.identify(make(*docs, *odd)).collect()
    found = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    held = [d for d in docs if found[d[0]]["held_out"]]
    assert 150 < len(held) < 300
    assert sum(found[i]["lang_pred"] == lang for i, _, lang in held) / len(held) > 0.98
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (5000, 5001, 5002))
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(docs) + len(odd)
    learned = language_id.learn(make(*docs, *odd))
    kept = language_id.recognized(make(*docs, *odd), learned, 0.1)
    assert kept.count() == len(docs) + 3 and kept.columns == make().columns
    # held-out and unlabelled rows teach nothing
    unlabelled = [(i, t, lang if not found[i]["held_out"] else "zz") for i, t, lang in docs]
    assert language_id.learn(make(*unlabelled)).languages == ["aa", "bb", "cc"]
    nothing = language_id.identify(make((1, "some text")))
    assert nothing.first()["lang_pred"] == "und"
    assert language_id.identify(make().limit(0)).count() == 0


def test_filter_returns_all_languages_of_a_gram():
    import numpy as np

    grams = [np.arange(0, 5000), np.arange(2500, 7500), np.array([], np.int64)] + [np.array([9])] * 7
    made = language_id.LanguageFilter([f"l{i}" for i in range(10)], grams, 0)
    masks = made.masks(np.arange(2500, 5000).astype(np.uint32))
    assert masks.shape[0] == 2 and (masks[0] & 3 == 3).all()
    only = made.masks(np.arange(0, 2500).astype(np.uint32))
    assert ((only[0] & 2) != 0).mean() < 0.02
    assert (made.masks(np.array([9], np.uint32))[1] & 3 == 3).all()


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_monotone_and_reaches_what_is_there():
    rng = random.Random(6)
    for _ in range(200):
        template = [rng.choice("abcdefghij") + str(rng.randrange(4)) for _ in range(30)]
        text = [w for w in template if rng.random() > 0.1]
        for _ in range(rng.randint(0, 5)):
            text.insert(rng.randrange(len(text) + 1), "new")
        pairs = license_scan.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) >= 0.8 * lcs(text, template)


def test_licenses_are_found_in_edited_and_long_texts(make, prose):
    mit = license_scan.TEMPLATES["MIT"]
    words = mit.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 12)
    filler = " ".join(prose(1, 20, 400))
    docs = [
        (1, mit), (2, f"{filler}\n// {mit.upper()} //\n{filler}"), (3, edited), (4, " ".join(words[: len(words) // 2])),
        (5, None), (6, ""), (7, f"{filler} Released under the MIT License. {filler}"), (7, "the " * 20_000), (8, mit + " x " + mit),
        (9, "MIT License the under Released."),
    ]
    found = {}
    for r in license_scan.find_licenses(make(*docs)).collect():
        found.setdefault(r["doc_id"], {})[r["license"]] = r
    assert {1, 2, 3, 7, 8} == set(found)
    assert found[1]["MIT"]["coverage"] == found[2]["MIT"]["coverage"] == found[8]["MIT"]["coverage"] == 1.0
    assert 0.85 < found[3]["MIT"]["coverage"] < 1
    assert set(found[7]) == {"MIT line"} and found[7]["MIT line"]["n_aligned"] == 5
    assert license_scan.find_licenses(make().limit(0)).count() == 0


def test_common_licenses_are_told_apart(make, prose):
    lines = {
        "Released under the BSD License": {"BSD line"},
        "Licensed under CC BY-SA 4.0.": {"CC-BY-SA-4.0 line"},
        "licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License": {"CC-BY-NC-3.0 line"},
        "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.": {"CC-BY-4.0 line", "CC-BY-NC-4.0 line"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0 line"},
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0 line"},
        "Licensed under the GNU Lesser General Public License v2.1": {"LGPL-2.1 line"},
        "Licensed under GPLv3": {"GPL-3.0 line"},
        "Licensed under the Apache License, Version 1.1.": set(),
        "The GNU General Public License, version 3, is long.": set(),
    }
    filler = " ".join(prose(1, 5, 100))
    docs = [(i, f"{filler}\n{text}\n{filler}") for i, text in enumerate(lines)]
    whole = [n for n in license_scan.TEMPLATES if not n.endswith("line") and n != "Apache-2.0 notice"]
    docs += [(100 + i, f"{filler}\n{license_scan.TEMPLATES[n]}\n{filler}") for i, n in enumerate(whole)]
    found = {doc_id: set() for doc_id, _ in docs}
    for r in license_scan.find_licenses(make(*docs)).collect():
        found[r["doc_id"]].add(r["license"])
        assert r["doc_id"] < 100 or r["coverage"] == 1
    assert found == dict(enumerate(lines.values())) | {100 + i: {n} for i, n in enumerate(whole)}
    families = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-NC-4.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0", "Unlicense")
    assert set(families) <= set(whole) and "IN NO EVENT" in license_scan.TEMPLATES["ISC"]
