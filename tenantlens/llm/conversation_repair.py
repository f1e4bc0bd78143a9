r"""Cheapest repair of conversations, by a rank-convergent parallel Viterbi search.

A conversation shall read ``(system? (user assistant)+)?`` by the initials of its
roles. Its rows are kept (0), given another role (R, 2), deleted (D, 3) or have an
empty row put before them (I, 2); rows that are blank or repeat an earlier role and
text must go, a truncated row that stays costs 1. Four states say what the repaired
conversation ends in so far: nothing, a system, a user or an assistant row.

*Backward costs.* ``h[q]`` is the least cost of finishing from state ``q``. A row
turns the vector after it into the one before it. Differences within a vector are
small, so up to a constant there are few vectors: they are numbered, and a row is
one look-up (``NEXT``, ``ADDED``). Two vectors that differ by a constant have the
same number, and stay equal from there on: that is the convergence of the method.

*Chunks.* Conversations at the edge of a task or with many rows lie in blocks (see
``ordered``). Each block is first run backward from a speculative vector, that of
the end of a conversation. A scan of the blocks' outcomes hands on the true vectors;
blocks that began from another one run again beside their first run and stop where
both have the same number. What a block makes of a vector is kept, so passes are
repeated only until every vector met has been tried. Then the four states are led
through the blocks, and each block is traced from its true state.

*Audit.* At each row the ASCII-least edit that keeps to the backward costs is taken:
D, I, K, R. From a state, an edit leads to one state only, so the audit fixes the
repaired rows.

Scale: a task sees only whole small conversations and blocks of bounded size. The
scans over blocks hold one row per block. The digest of one conversation's repaired
text (``report``) is a hash of one sequence: its blocks stream through one task.

Defined cases: rows lie by turn (null first), then by digest of role and text; a null
role or text is one space; a null ``conv_id`` is a conversation of its own; equal
rows are repeats; a conversation without rows has zeros and an empty audit; an empty
table gives an empty result; other columns take no part.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantlens.llm.common import sliced, stored
from tenantlens.llm.ordered import BLOCK_ROWS, Stretch, dealt, in_batches, scanned, stretches, typed

EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
TURNED = (USER, USER, ASSISTANT, USER)  # state after a row of the role that may follow
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = ({EMPTY: SYSTEM}, {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
BLANK, DUPLICATE, FREE = 0, 1, 2  # kinds of rows: FREE + 2 * initial + truncated
KINDS = range(FREE, FREE + 8)

COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def closed(costs: list[float]) -> tuple[float, ...]:
    """Costs when empty rows may be put in first."""
    costs = list(costs)
    for _ in STATES:
        costs = [min(c, INSERT + costs[TURNED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def edits(kind: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of what may become of a row; no insertion."""
    yield "D", DELETE, state
    if kind >= FREE:
        initial, truncated = divmod(kind - FREE, 2)
        if state in KEPT[initial]:
            yield "K", KEEP + TRUNCATED * truncated, KEPT[initial][state]
        yield "R", REROLE + TRUNCATED * truncated, TURNED[state]


def before(kind: int, after: tuple[float, ...]) -> tuple[float, ...]:
    return closed([min(cost + after[to] for _, cost, to in edits(kind, q)) for q in STATES])


END = closed([0, float("inf"), float("inf"), 0])


def _numbered() -> tuple[list[tuple], list[dict], list[dict]]:
    """All vectors reachable from the end of a conversation, least cost 0 in each."""
    vectors, steps, added = [END], [], []
    for vector in vectors:  # grows meanwhile
        steps.append({})
        added.append({})
        for kind in KINDS:
            came = before(kind, vector)
            low = min(came)
            came = tuple(c - low for c in came)
            if came not in vectors:
                vectors.append(came)
            steps[-1][kind], added[-1][kind] = vectors.index(came), int(low)
    return vectors, steps, added


VECTORS, NEXT, ADDED = _numbered()


def _move(vector: tuple, after: tuple, low: float, kind: int, state: int) -> tuple[str, int]:
    """Edits up to and with this row, and the state behind it."""
    done = ""
    while True:
        left = vector[state] + low
        ways = [(edit, to) for edit, cost, to in edits(kind, state) if cost + after[to] == left]
        if INSERT + vector[TURNED[state]] == vector[state]:
            ways.append(("I", -1))
        edit, to = min(ways)
        done += edit
        if edit != "I":
            return done, to
        state = TURNED[state]


MOVES = [
    {
        (kind, q): _move(VECTORS[NEXT[after][kind]], VECTORS[after], ADDED[after][kind], kind, q)
        for kind in KINDS
        for q in STATES
    }
    for after in range(len(VECTORS))
]


def backward(kinds: bytes, right: int, beside: list[int] | None = None) -> tuple[list[int], int]:
    """Number of the vector after each row, and of the one before all rows.

    ``beside`` are the vectors of an earlier run: this run ends where it meets them,
    since equal numbers stay equal.
    """
    trail, at = [right] * len(kinds), right
    for i in range(len(kinds) - 1, -1, -1):
        if beside is not None and beside[i] == at:
            return beside[: i + 1] + trail[i + 1 :], -1
        trail[i] = at
        if kinds[i] >= FREE:
            at = NEXT[at][kinds[i]]
    return trail, at


def forward(kinds: bytes, trail: list[int], state: int) -> tuple[list[str], int]:
    """Edits of each row from a state on, and the state behind them."""
    done = []
    for kind, after in zip(kinds, trail, strict=True):
        if kind < FREE:
            done.append("D")
        else:
            edit, state = MOVES[after][kind, state]
            done.append(edit)
    return done, state


def closing(state: int) -> str:
    """Insertions at the end of a conversation."""
    return {SYSTEM: "II", USER: "I"}.get(state, "")


COST = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def repaired(kinds: bytes, audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list, list, int]:
    """Roles and texts that an audit leaves, and its cost."""
    out_roles, out_texts, cost, row = [], [], 0, 0
    for edit in audit:
        cost += COST[edit]
        if edit in "IR":
            state = TURNED[state]
            out_roles.append(ROLE[state])
            out_texts.append(texts[row] if edit == "R" else "")
        elif edit == "K":
            state = KEPT[(kinds[row] - FREE) // 2][state]
            out_roles.append(roles[row])
            out_texts.append(texts[row])
        if edit in "KR":
            cost += TRUNCATED * ((kinds[row] - FREE) % 2)
        row += edit != "I"
    return out_roles, out_texts, cost


def marked(rows: DataFrame) -> DataFrame:
    """Rows with what the search needs to know of each: its kind without repeats, its
    initial and a digest of conversation, role and text. ``copies`` 0 only names a conversation."""
    white = " \\t\\n\\u000b\\f\\r"
    last = F.expr(f"right(rtrim('{white}', text), 1)")
    at = f"instr('{INITIALS}', initial)"
    code = F.expr(f"CASE WHEN initial = '' OR {at} = 0 THEN {len(INITIALS)} ELSE {at} - 1 END")
    whose = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    told = F.concat_ws("|", F.length(whose), F.length("role"), whose, "role", "text")
    return rows.withColumn("initial", F.expr("left(role, 1)")).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        "copies",
        "initial",
        F.when(last == "", BLANK)
        .otherwise(FREE + 2 * code + (~last.isin(".", "!", "?")).cast("int"))
        .alias("kind"),
        F.unhex(F.sha2(told, 256)).alias("mark"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a lossy export leaves them, by crc32 of ``conv_id:turn`` modulo 20: 0 is
    lost, 1 has no text, 2 no sentence ends, 3 comes twice, 4 has the role user. Nulls
    count as one space. A lost row stays as a row of no copies."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = F.crc32(F.concat_ws(":", *spaced).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    lost = hit == 0
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), hit.alias("hit")).select(
        "conv_id",
        F.when(~lost, F.col("turn")).alias("turn"),
        F.when(lost, "").when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(lost | (hit == 1), "").when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(lost, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


PLACE = "part int, block int, whole boolean, first_turn long, last_turn long, turns long"
FOUND = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles array<string>, texts array<string>"
RAW = "initials string, kinds binary, marks binary"
MARK = 32  # bytes


def _first_kinds(stretch: Stretch) -> tuple[dict[str, list], bytes]:
    """The rows of a block, copies beside each other, and their kinds with the repeats seen here."""
    columns, kinds, seen = stretch.columns, bytearray(), set()
    rows: dict[str, list] = {c: [] for c in ("turn", "role", "text", "initial", "mark")}
    for i, (kind, copies) in enumerate(zip(columns["kind"], columns["copies"], strict=True)):
        for _ in range(copies):
            mark = columns["mark"][i]
            kinds.append(DUPLICATE if kind != BLANK and mark in seen else kind)
            seen.add(mark)
            for c, values in rows.items():
                values.append(columns[c][i])
    return rows, bytes(kinds)


def _counts(kinds: bytes, initials: str, previous: str | None = None) -> tuple[int, int, int, int]:
    """Rows blank, duplicate and truncated, and neighbours that may not follow each other."""
    truncated = sum(kinds.count(k) for k in KINDS if k % 2 != FREE % 2)
    line = (previous or "") + initials
    return kinds.count(BLANK), kinds.count(DUPLICATE), truncated, sum(a + b not in LEGAL for a, b in itertools.pairwise(line))


def blocks_of(rows: DataFrame, most_rows: int = BLOCK_ROWS) -> DataFrame:
    """Whole conversations repaired; others as blocks (part, block) with what the search needs."""
    schema = typed(rows, "conv_id", ddl=f"{PLACE}, {FOUND}, {RAW}")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for stretch in stretches(batches, "conv_id", most_rows):
            rows, kinds = _first_kinds(stretch)
            turns = [t for t in rows["turn"] if t is not None]
            place = (stretch.key, stretch.part, stretch.block, stretch.whole)
            place += (turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)))
            initials = "".join(x or " " for x in rows["initial"])
            if stretch.whole:
                done, state = forward(kinds, backward(kinds, 0)[0], EMPTY)
                audit = "".join(done) + closing(state)
                roles, texts, cost = repaired(kinds, audit, EMPTY, rows["role"], rows["text"])
                yield *place, *_counts(kinds, initials), cost, audit, roles, texts, None, None, None
            else:
                yield *place, *[None] * 6, rows["role"], rows["text"], initials, kinds, b"".join(rows["mark"])

    ordered = dealt(rows, "conv_id", "turn", "mark")
    return ordered.mapInArrow(lambda batches: in_batches(found(batches), schema), schema)


def _with_repeats(blocks: DataFrame) -> DataFrame:
    """Blocks without their texts; rows that repeat one of an earlier block are duplicates."""
    kept = ["conv_id", "part", "block", "first_turn", "last_turn", "turns", "initials", "kinds"]
    thin = blocks.select(*kept, "marks")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 16):
            for part, block, kinds, marks in zip(
                *(batch.column(c).to_pylist() for c in ("part", "block", "kinds", "marks")), strict=True
            ):
                mine = [marks[MARK * i : MARK * i + MARK] for i, kind in enumerate(kinds) if kind >= FREE]
                n = len(mine)
                yield pa.record_batch(
                    [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(mine, pa.binary())],
                    ["part", "block", "mark"],
                )

    marks = stored(thin.mapInArrow(each, "part int, block int, mark binary"), "repair-marks")
    place = F.struct("part", "block")
    firsts = marks.groupBy("mark").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = marks.join(firsts, "mark").filter(place != F.col("first"))
    gone = again.groupBy("part", "block").agg(F.collect_list("mark").alias("gone"))  # of one block
    schema = typed(thin, *kept)

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 16):
            for row in batch.to_pylist():
                bad, kinds = set(row["gone"] or ()), bytearray(row["kinds"])
                for i in range(len(kinds) if bad else 0):
                    if kinds[i] != BLANK and row["marks"][MARK * i : MARK * i + MARK] in bad:
                        kinds[i] = DUPLICATE
                yield *[row[c] for c in kept[:-1]], bytes(kinds)

    joined = thin.join(gone, ["part", "block"], "left")
    return joined.mapInArrow(lambda batches: in_batches(flagged(batches), schema), schema)


def _handed_back(row: dict, carried: int | None) -> tuple[tuple, int]:
    """The vector behind a block, as far as its outcomes are known."""
    right, known = carried or 0, dict((o["right"], o["left"]) for o in row["outcomes"])
    return (right, right in known, carried is None), known.get(right, known[0])


def _outcomes(blocks: DataFrame) -> DataFrame:
    """What each block makes of the vectors it was run from."""
    schema = typed(blocks, "conv_id", "part", "block", "right", ddl="left int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 64):
            for row in batch.to_pylist():
                first, left = backward(row["kinds"], 0)
                if row["right"]:
                    met, other = backward(row["kinds"], row["right"], first)
                    left = left if other < 0 else other
                yield row["conv_id"], row["part"], row["block"], row["right"], left

    return blocks.mapInArrow(lambda batches: in_batches(run(batches), schema), schema)


def right_vectors(blocks: DataFrame) -> tuple[DataFrame, int]:
    """part, block, right, last: the true vector behind each block; and the passes it took."""
    known = stored(_outcomes(blocks.withColumn("right", F.lit(0))), "repair-pass")
    passes = 1
    while True:
        outcomes = known.groupBy("conv_id", "part", "block").agg(
            F.collect_list(F.struct("right", "left")).alias("outcomes")  # VECTORS at most
        )
        scan = scanned(outcomes, _handed_back, "right int, known boolean, last boolean", last_first=True)
        scan = stored(scan.drop("conv_id"), "repair-scan")
        missing = scan.filter("NOT known").select("part", "block", "right")
        if missing.isEmpty():
            return scan.drop("known"), passes
        known = known.unionByName(stored(_outcomes(blocks.join(missing, ["part", "block"])), "repair-pass"))
        passes += 1


def _led(row: dict, carried: tuple | None) -> tuple[tuple, tuple]:
    """State, last turn and last initial before a block."""
    state, turn, initial = carried or (EMPTY, None, None)
    behind = (
        row["ends"][state],
        turn if row["last_turn"] is None else row["last_turn"],
        row["last_initial"] or initial,
    )
    return (state, turn, initial), behind


def _spread_repaired(blocks: DataFrame) -> DataFrame:
    """Conversations in several blocks."""
    kinds = stored(_with_repeats(blocks), "repair-kinds")
    rights, _ = right_vectors(kinds)
    placed = kinds.join(rights, ["part", "block"])
    ends = typed(placed, "conv_id", "part", "block", "last_turn", ddl="last_initial string, ends array<int>")

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 64):
            for row in batch.to_pylist():
                trail, _ = backward(row["kinds"], row["right"])
                to = [forward(row["kinds"], trail, q)[1] for q in STATES]
                yield *[row[c] for c in ("conv_id", "part", "block", "last_turn")], row["initials"][-1:], to

    ways = placed.mapInArrow(lambda batches: in_batches(led(batches), ends), ends)
    states = scanned(ways, _led, "state int, turn_before long, initial_before string").drop("conv_id")
    texts = blocks.select("part", "block", "whole", "roles", "texts")
    whole = placed.join(states, ["part", "block"]).join(texts, ["part", "block"])
    schema = typed(blocks, "conv_id", ddl=f"{PLACE}, {FOUND}")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in sliced(batches, 16):
            for row in batch.to_pylist():
                line, state = row["kinds"], row["state"]
                done, end = forward(line, backward(line, row["right"])[0], state)
                audit = "".join(done) + (closing(end) if row["last"] else "")
                roles, out, cost = repaired(line, audit, state, row["roles"], row["texts"])
                shared = row["first_turn"] is not None and row["first_turn"] == row["turn_before"]
                yield (
                    *[row[c] for c in ("conv_id", "part", "block", "whole", "first_turn", "last_turn")],
                    row["turns"] - shared,
                    *_counts(line, row["initials"], row["initial_before"]),
                    cost,
                    audit,
                    roles,
                    out,
                )

    return whole.mapInArrow(lambda batches: in_batches(traced(batches), schema), schema)


def repair(rows: DataFrame, most_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repaired conversations in blocks (part, block) of at most about ``most_rows`` rows:
    the faults found, the cheapest edits (``audit``) with their cost, and the roles and
    texts that they leave. ``rows`` have conv_id, turn, role, text, copies."""
    blocks = stored(blocks_of(marked(rows), most_rows), "repair-blocks")
    raw = [f.split()[0] for f in RAW.split(", ")]
    spread = blocks.filter("NOT whole")
    return blocks.filter("whole").drop(*raw).unionByName(_spread_repaired(spread))


def repaired_rows(blocks: DataFrame) -> DataFrame:
    """conv_id, part, block, at, role, text: the rows left, in this order."""
    zipped = F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")
    rows = blocks.select("conv_id", "part", "block", zipped)
    return rows.select("conv_id", "part", "block", "at", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def report(blocks: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit, and the digest of the repaired
    ``role:text`` lines. Blocks of one conversation pass through one task in order, one
    at a time."""
    line = F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat_ws(":", x["roles"], x["texts"]))
    lined = blocks.withColumn("lines", F.array_join(line, "\n")).withColumn("n", F.size("roles"))
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    one = lined.filter("whole").select(
        "conv_id", gaps.alias("gaps"), *sums, "audit", F.sha2("lines", 256).alias("repaired_sha256")
    )
    schema = typed(blocks, "conv_id", ddl=f"{COUNTS}, audit string, repaired_sha256 string")
    several = lined.filter("NOT whole").drop("roles", "texts", "whole")
    several = several.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = (row for batch in sliced(batches, 16) for row in batch.to_pylist())
        for conv_id, mine in itertools.groupby(rows, lambda row: row["conv_id"]):
            total, first, last, turns = dict.fromkeys(sums, 0), None, None, 0
            audit, digest, lines = [], hashlib.sha256(), 0
            for row in mine:
                for c in sums:
                    total[c] += row[c]
                audit.append(row["audit"])
                first = row["first_turn"] if first is None else first
                last = last if row["last_turn"] is None else row["last_turn"]
                turns += row["turns"]
                if row["n"]:
                    digest.update(b"\n" * (lines > 0) + row["lines"].encode())
                lines += row["n"]
            gaps = 0 if first is None else last - first + 1 - turns
            yield conv_id, gaps, *total.values(), "".join(audit), digest.hexdigest()

    return one.unionByName(several.mapInArrow(lambda batches: in_batches(summed(batches), schema), schema))
