"""Conversation repair and prefix trie against brute force; SentencePiece against its library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenantlens.llm import conversation_repair, piece_codec, prefix_trie
from tenantlens.llm.common import stored

TALK = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
WHITE = " \t\n\x0b\f\r"
CLASHING = ["mark", "kind", "copies", "part", "block", "n", "d1", "size", "base", "at", "_tie", "whole", "initial"]


@pytest.fixture(scope="session")
def talks(spark):
    """Conversations from (conv_id, turn, role, text), with clashing columns beside them."""

    def build(rows):
        made = spark.createDataFrame(rows, TALK)
        return made.withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)

    return build


def spoken(seed, conversations, turns=12, ids=None):
    rng = random.Random(seed)
    rows = []
    for c in ids or range(conversations):
        role = rng.choice(["system", "user", "user"])
        for turn in range(rng.randint(0, turns)):
            text = rng.choice(["Yes.", "No", "so it is!", "Why?", "", " \t", f"{rng.randint(0, 30)} of them."])
            rows.append((c, turn, role, text))
            follow = {"system": "user", "user": "assistant", "assistant": "user"}.get(role, "user")
            role = rng.choice([follow] * 5 + ["system", "user", "assistant", "tool", ""])
    return rows


ODD = [
    (None, 0, "user", "Lost."),
    (None, None, None, None),
    (900, None, "user", None),
    (900, None, "user", "First."),
    (901, 3, "user", "Tie."),
    (901, 3, "user", "Tie."),
    (901, 3, "assistant", "Tie."),
    (902, -5, "system", "w" * 300_000),
    (902, 9, "assistant", "w " * 100_000 + "."),
    (-7, 1, "user", "Below."),
    (-5, 1, "user", "Below."),
    (-5, 2, "", "."),
]


def faulty(rows):
    """conv_id -> rows in order (turn, role, text) as damaged."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 1:
            text = ""
        if hit == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if hit == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for conv, mine in out.items():
        whose = "" if conv is None else f"={conv}"

        def place(row, whose=whose):
            told = f"{len(whose)}|{len(row[1])}|{whose}|{row[1]}|{row[2]}"
            return row[0] is not None, row[0] or 0, hashlib.sha256(told.encode()).digest()

        mine.sort(key=place)
    return out


def cheapest(rows):
    """Least (cost, audit) with what it leaves, by all ways to each state."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    named = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, left) in list(best.items()):
                for new in "ua":
                    if (state, new) in legal:
                        way = (cost + 2, audit + "I", [*left, named[new] + ":"])
                        best[new] = min(best.get(new, way), way, key=lambda w: w[:2])
        return best

    best, seen, faults = {"": (0, "", [])}, set(), []
    for _, role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        after = {}
        for state, (cost, audit, left) in inserted(best).items():
            ways = [(state, (cost + 3, audit + "D", left))]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (state, role[:1]) in legal:
                    ways.append((role[:1], (cost + more, audit + "K", [*left, f"{role}:{text}"])))
                for new in "ua":
                    if (state, new) in legal:
                        ways.append((new, (cost + 2 + more, audit + "R", [*left, f"{named[new]}:{text}"])))
            for state_after, way in ways:
                after[state_after] = min(after.get(state_after, way), way, key=lambda w: w[:2])
        best = after
    best = inserted(best)
    cost, audit, left = min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])
    return faults, cost, audit, left


def reported(rows):
    out = []
    for conv, mine in faulty(rows).items():
        faults, cost, audit, left = cheapest(mine)
        turns = [t for t, _, _ in mine if t is not None]
        initials = [r[:1] for _, r, _ in mine]
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
                cost,
                audit,
                hashlib.sha256("\n".join(left).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


REPORT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("most_rows", [2, 5, 4096])
def test_repair_equals_brute_force(talks, most_rows):
    rows = spoken(most_rows, 60) + ODD
    rows += [(50_000, t, "user", f"{t % 7} again.") for t in range(120)]  # no convergence: user rows alone
    rows += [(50_001, t, "user", f"Row {t}.") for t in range(121)]
    rows += [(50_002, t, "xyz"[t % 3], f"Row {t}") for t in range(40)]
    rows += [(50_003, t, "user", "") for t in range(50)]
    blocks = conversation_repair.repair(conversation_repair.damaged(talks(rows)), most_rows)
    found = sorted((tuple(r[c] for c in REPORT) for r in conversation_repair.report(blocks).collect()), key=str)
    assert found == reported(rows)
    left = conversation_repair.repaired_rows(blocks).filter("conv_id = 50001").orderBy("part", "block", "at").collect()
    texts = "\n".join(f"{r['role']}:{r['text']}" for r in left)
    digest = {r[0]: r[-1] for r in found}[50_001]
    assert hashlib.sha256(texts.encode()).hexdigest() == digest


def test_repair_of_nothing(talks):
    damaged = conversation_repair.damaged(talks(ODD).limit(0))
    assert conversation_repair.report(conversation_repair.repair(damaged)).count() == 0
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = conversation_repair.repair(conversation_repair.damaged(talks([(lost, 0, "user", "Gone.")])))
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r[c] for c in REPORT) for r in conversation_repair.report(rows).collect()] == [(lost, *[0] * 6, "", empty)]


def test_fixed_up_runs_meet_the_first_one():
    rng = random.Random(3)
    for _ in range(200):
        kinds = bytes(rng.choice([0, 1, *conversation_repair.KINDS]) for _ in range(rng.randint(0, 30)))
        first, left = conversation_repair.backward(kinds, 0)
        for right in range(len(conversation_repair.VECTORS)):
            trail, alone = conversation_repair.backward(kinds, right)
            beside, met = conversation_repair.backward(kinds, right, first)
            assert beside == trail and (left if met < 0 else met) == alone


def test_passes_do_not_grow_with_the_blocks(spark, talks):
    """Rows of one role carry the vector from the end to the start of a conversation."""
    rows = [(1, t, "user", f"Row {t}.") for t in range(90)]
    undamaged = talks(rows).withColumn("copies", F.lit(1))
    blocks = conversation_repair.blocks_of(conversation_repair.marked(undamaged), 3).filter("NOT whole")
    kinds = stored(conversation_repair._with_repeats(blocks), "test")
    assert kinds.count() >= 30
    assert conversation_repair.right_vectors(kinds)[1] <= 4


def trie_by_brute_force(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role)}|{role}|{text}".encode()).digest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0, told), (role, text)))
    own = {c: [t for _, t in sorted(mine, key=lambda x: x[0])] for c, mine in convs.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in inside if built[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(inside), len(node), parent, len(inside), len(kids), len(leaves), saved, sha))
    return sorted(out, key=str)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize(("most_rows", "most", "unit"), [(3, 8, 5), (16, 40, 30), (4096, 10**6, 10**6)])
def test_trie_equals_brute_force(talks, most_rows, most, unit):
    rows = spoken(most_rows + 1, 70) + ODD
    rows += [(1000 + c, t, "user", "All begin so.") for c in range(25) for t in range(3)]  # hot prefix, copies
    rows += [(2000, t, "user", f"Long {t}") for t in range(50)] + [(2004, t, "user", f"Long {t}") for t in range(60)]
    result = prefix_trie.trie(prefix_trie.paths(talks(rows), most_rows=most_rows), most, unit)
    assert sorted((tuple(r[c] for c in NODE) for r in result.collect()), key=str) == trie_by_brute_force(rows)


def test_trie_of_nothing(talks):
    for rows in (talks(ODD).limit(0), talks(ODD[:2])):
        assert prefix_trie.trie(prefix_trie.paths(rows)).count() == 0


def test_slot_table_is_minimal_and_tells_foreign_keys():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**60, (20_000, 2)), axis=0)
    table = prefix_trie.SlotTable(keys[:, 0].copy(), keys[:, 1].copy())
    slots = table.slots(keys[:, 0], keys[:, 1])
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert (table.slots(keys[:, 0] + 1, keys[:, 1]) == -1).all()


@pytest.fixture(scope="module")
def codec():
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("piece_bpe_32k.model"), "rb") as file:
        return piece_codec.PieceCodec(file.read())


def test_pieces_equal_the_library(codec, prose):
    rng = random.Random(7)
    alphabet = "ab ▁\n\t\x00é漢😀<>s/0x1A.  "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    texts += prose(6, 40) + ["", " ", "   ", "a" * 5000, "word " * 3000, "😀" * 300, "\n\n", "<s></s><unk>"]
    ids = codec.encode(texts)
    assert ids == codec.library.encode(texts)
    assert [codec.decode(i) for i in ids] == codec.library.decode(ids)
    rows = [[rng.randrange(32_000 if n % 2 else 300) for _ in range(rng.randint(0, 9))] for n in range(3000)]
    assert [codec.decode(r) for r in rows] == codec.library.decode(rows)


def test_both_agendas_merge_alike(codec):
    rng = random.Random(8)
    segments = ["▁" + "".join(rng.choice("aeinrst▁é漢") for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    assert codec.many_ids(segments) == [codec.segment_ids(s) for s in segments]


def test_pieces_of_documents(spark, make, codec):
    public = pytest.importorskip("public_tokenizers")
    long = "one two  three\n" * 60_000
    docs = make((None, None), (1, None), (2, ""), (3, "Ein Wort."), (3, "Ein Wort."), (4, long))
    rows = piece_codec.coded(docs, public.path("piece_bpe_32k.model")).collect()
    by_id = {r["doc_id"]: (r["ids"], r["decoded"]) for r in rows}
    assert len(rows) == 6 and by_id[1] == by_id[2] == by_id[None] == ([], "")
    assert by_id[4] == (codec.library.encode(long), long)
    assert piece_codec.coded(make().limit(0), public.path("piece_bpe_32k.model")).count() == 0


def test_a_difference_from_the_library_stops_the_job(codec, monkeypatch):
    monkeypatch.setattr(codec, "many_ids", lambda segments: [[5]] * len(segments))
    monkeypatch.setattr(codec, "kept", {})
    with pytest.raises(ValueError, match="differ"):
        codec.encode(["Some words here."], check=True)
