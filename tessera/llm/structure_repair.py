"""Repair of the structure of conversations at least cost, by run-length dynamic programming.

A conversation is sound if the initials of its roles, in order, read (s?(ua)+)? and no row is blank, repeated or cut
off. Edits: Keep a row (0), Rerole it to user or assistant (1), Delete it (2), Insert an empty row of either role
anywhere (5); a cut-off row that is not deleted adds 5; blank and repeated rows have to be deleted. Of the cheapest
sequences of edits the one whose initials are least in ASCII is taken.

Symbols. Only the initial of a row's role and its fault matter: nine symbols. Between rows there are four states (the
last role: none, system, user, assistant), and each symbol is a 4 by 4 matrix of least costs over minimum and plus, in
which insertions before the row are closed. Equal consecutive symbols are one run; a run of any length is applied by
the binary powers of its matrix, which are cached. From the costs to go at the ends of runs the choices are unrolled
row by row; a letter leads to one state only, so the least letter of a cheapest continuation gives the least audit.

Scale. Rows equal in conversation, turn, role and text are first counted, by digest. Their numbers are then sorted by
range, so that a conversation of any length is cut into fragments, one for each partition it reaches. Conversations
within one partition are solved there. Of the two that may go on in the neighbouring partitions, the fragments send one
matrix each, whose products give every fragment its state at the start and its costs to go at the end; then fragments
are unrolled apart. Texts are shuffled only where repaired rows are asked for. What is one value a conversation stays
so: its audit is one string, and `texts_sha256` reads its rows in order in one task, batch by batch.

Defined results: a null role or text counts as one space. Rows are in order of turn (null first), then role, then
SHA-256 of role and text. Rows without conv_id form one conversation, of id null. Repeated rows are duplicates. An
empty table gives an empty result; further columns are ignored. Equality of role and text is that of their SHA-256.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import if_few, stage_table

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: States: the last role of the repaired rows. The role that an inserted or reroled row takes is the same for each.
NONE, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
NAMES = (None, None, "user", "assistant")
FAR = 1 << 60
#: Costs of closing a conversation from each state.
CLOSE = (0, 2 * INSERT, INSERT, 0)
#: A row that has to go; other symbols are 1 + 2 * initial + (1 if cut off), with initials other, s, u, a from 0.
GONE = 0
INITIALS = {"s": 1, "u": 2, "a": 3}

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def _kept_state(symbol: int, state: int) -> int | None:
    """The state after keeping a row, or None where its role may not follow."""
    initial = (symbol - 1) // 2
    if initial == SYSTEM:
        return SYSTEM if state == NONE else None
    return initial if initial and initial == FOLLOWS[state] else None


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up a row: letter, cost, next state; in order of letters."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        more = CUT_OFF * (1 - symbol % 2)
        kept = _kept_state(symbol, state)
        if kept is not None:
            out.append(("K", more, kept))
        out.append(("R", REROLE + more, FOLLOWS[state]))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    """Product over minimum and plus."""
    return tuple(tuple(min(min(x + y[j] for x, y in zip(row, b)), FAR) for j in range(4)) for row in a)


def before(a: Matrix, v: Vector) -> Vector:
    """Costs to go before a matrix, from those after it."""
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> Matrix:
    """The matrix of 2 ** k rows of a symbol."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    rows = []
    for state in range(4):
        row, at, cost = [FAR] * 4, state, 0
        for _ in range(3):  # no insertion, one, or both roles
            for _, c, to in _moves(symbol, at):
                row[to] = min(row[to], cost + c)
            at, cost = FOLLOWS[at], cost + INSERT
        rows.append(tuple(row))
    return tuple(rows)


def _bits(count: int):
    return (k for k in range(count.bit_length()) if count >> k & 1)


def run_matrix(runs: list[tuple[int, int]]) -> Matrix:
    """The matrix of consecutive runs (symbol, count)."""
    out = IDENTITY
    for symbol, count in runs:
        for k in _bits(count):
            out = times(out, power(symbol, k))
    return out


def collapse(symbols: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Equal consecutive symbols as one run each."""
    return [(s, sum(n for _, n in group)) for s, group in groupby(symbols, key=lambda x: x[0])]


def _level(v: Vector) -> Vector:
    least = min(v)
    return tuple(x - least for x in v)


@lru_cache(maxsize=None)
def _one_before(symbol: int, after: Vector) -> Vector:
    return _level(before(power(symbol, 0), after))


@lru_cache(maxsize=None)
def _choice(symbol: int, after: Vector, state: int) -> tuple[tuple[str, int], ...]:
    """The least letters of a cheapest way over one row, insertions before it first, each with the state it leads to."""
    need = before(power(symbol, 0), after)
    steps = []
    while True:
        moves = [(letter, c + after[to], to) for letter, c, to in _moves(symbol, state)]
        moves.append(("I", INSERT + need[FOLLOWS[state]], FOLLOWS[state]))
        letter, _, to = min(m for m in moves if m[1] == need[state])
        steps.append((letter, to))
        state = to
        if letter != "I":
            return tuple(steps)


def unroll(runs: list[tuple[int, int]], state: int, after: Vector):
    """The steps (letter, state) of each row of the runs, from `state`, with costs to go `after` the last row."""
    ends, v = [], after
    for symbol, count in reversed(runs):
        ends.append(_level(v))
        for k in _bits(count):
            v = before(power(symbol, k), v)
    for (symbol, count), end in zip(runs, reversed(ends)):
        inner = [end]
        for _ in range(count - 1):
            inner.append(_one_before(symbol, inner[-1]))
        for v in reversed(inner):
            steps = _choice(symbol, v, state)
            state = steps[-1][1]
            yield steps


def closing(state: int) -> list[tuple[str, int]]:
    """The insertions after the last row."""
    steps = []
    while CLOSE[state]:
        state = FOLLOWS[state]
        steps.append(("I", state))
    return steps


# ---- rows and fragments

_TABLE = {
    "kind": ("int", pa.int32()),
    "conv_id": ("long", pa.int64()),
    "slot": ("long", pa.int64()),
    "seq": ("long", pa.int64()),
    "rid": ("long", pa.int64()),
    "symbol": ("int", pa.int32()),
    "n": ("long", pa.int64()),
    "as_role": ("string", pa.string()),
    "audit": ("string", pa.string()),
    "facts": ("array<long>", pa.list_(pa.int64())),
}
_SCHEMA = ", ".join(f"{k} {v[0]}" for k, v in _TABLE.items())
EDITED, SOLVED, OPEN_ROW, OPEN_END = range(4)
#: The facts of a fragment, in order; its matrix follows.
FACTS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_turn", "last_turn", "first_initial", "last_initial")


class _Out:
    """Rows of _TABLE, sent in batches."""

    def __init__(self):
        self.rows = []

    def add(self, kind: int, **values):
        self.rows.append((kind, *[values.get(c) for c in list(_TABLE)[1:]]))

    def batches(self, least: int = 20_000):
        if len(self.rows) >= least and self.rows:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, t[1]) for c, t in zip(columns, _TABLE.values())], names=list(_TABLE))
            self.rows = []


def _facts(rows: list[tuple]) -> list[int | None]:
    """FACTS of consecutive rows (rid, turn, initial, n, blank, cut_off, later)."""
    blank = duplicate = truncated = illegal = turns = 0
    known = [r[1] for r in rows if r[1] is not None]
    last_turn, last = None, None
    for _, turn, initial, n, is_blank, cut_off, later in rows:
        if is_blank:
            blank += n
        else:
            duplicate += n if later else n - 1
            truncated += 0 if later else int(cut_off)
        illegal += n - 1  # no role follows itself
        if last is not None:
            illegal += (last, initial) not in _LEGAL
        if turn is not None and turn != last_turn:
            turns += 1
        last_turn, last = turn, initial
    low, high = (known[0], known[-1]) if known else (None, None)
    return [blank, duplicate, truncated, illegal, turns, low, high, rows[0][1], rows[-1][1], rows[0][2], rows[-1][2]]


_LEGAL = {(1, 2), (2, 3), (3, 2)}


def _symbol(initial: int, is_blank: bool, cut_off: bool, later: bool) -> int:
    return GONE if is_blank or later else 1 + 2 * initial + int(cut_off)


def _edits(out: _Out, conv_id: int | None, slot: int, rows: list[tuple[int, int, int]], state: int, after: Vector, close: bool) -> tuple[str, int]:
    """Adds the rows that stay of a fragment's rows (rid, symbol, n) to `out`; returns the audit and the last state.

    `after` are the costs to go after the last row; with `close` the conversation ends there.
    """
    runs = collapse([x for _, symbol, n in rows for x in ((symbol, 1), (GONE, n - 1)) if x[1]])
    ways = unroll(runs, state, after)
    audit, seq = [], 0

    def stay(steps, rid):
        nonlocal state, seq
        for letter, state in steps:
            audit.append(letter)
            if letter != "D":
                role = None if letter == "K" else NAMES[state]
                out.add(EDITED, conv_id=conv_id, slot=slot, seq=seq, rid=None if letter == "I" else rid, as_role=role)
                seq += 1

    for rid, _, n in rows:
        for _ in range(n):
            stay(next(ways), rid)
    if close:
        stay(closing(state), None)
    return "".join(audit), state


def _fragments(source):
    """Sorted rows of a partition: conversations within it are solved, its first and last are left open."""
    part = TaskContext.get().partitionId()
    out, held = _Out(), None

    def rows():
        for batch in source:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def left_open(conv_id, group, slot):
        for seq, (rid, _, initial, n, *fault) in enumerate(group):
            out.add(OPEN_ROW, conv_id=conv_id, slot=slot, seq=seq, rid=rid, symbol=_symbol(initial, *fault), n=n)
        symbols = [x for r in group for x in ((_symbol(r[2], *r[4:]), 1), (GONE, r[3] - 1)) if x[1]]
        matrix = run_matrix(collapse(symbols))
        out.add(OPEN_END, conv_id=conv_id, slot=slot, facts=[*_facts(group), *(x for row in matrix for x in row)])

    def solve(conv_id, group):
        symbols = [(r[0], _symbol(r[2], *r[4:]), r[3]) for r in group]
        runs = collapse([x for _, symbol, n in symbols for x in ((symbol, 1), (GONE, n - 1)) if x[1]])
        audit, _ = _edits(out, conv_id, 0, symbols, NONE, CLOSE, True)
        out.add(SOLVED, conv_id=conv_id, audit=audit, facts=[*_facts(group), before(run_matrix(runs), CLOSE)[NONE]])

    first = True
    for conv_id, group in groupby(rows(), key=lambda r: r[0]):
        if held:
            (left_open if first else solve)(*held, *([2 * part] if first else []))
            first = False
        held = conv_id, [r[1:] for r in group]
        yield from out.batches()
    if held:
        left_open(*held, 2 * part + (0 if first else 1))
    yield from out.batches(1)


_ENDS = "conv_id long, slot long, after array<long>, close boolean, cost long, facts array<long>"


def _join_ends(table: pa.Table) -> pa.Table:
    """Of the fragments of one conversation, at most one for each partition: the costs to go at the end of each, and
    in the row of the last one the cost and the facts of the whole."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("slot", "facts"))))
    k = len(FACTS)
    matrices = [tuple(tuple(f[k + 4 * i : k + 4 * i + 4]) for i in range(4)) for _, f in rows]
    facts = [dict(zip(FACTS, f)) for _, f in rows]
    afters = [CLOSE]
    for m in reversed(matrices):
        afters.append(before(m, afters[-1]))
    whole = {c: sum(f[c] for f in facts) for c in FACTS[:5]}
    for x, y in zip(facts, facts[1:]):
        whole["illegal"] += (x["last_initial"], y["first_initial"]) not in _LEGAL
        whole["turns"] -= x["last_turn"] is not None and x["last_turn"] == y["first_turn"]
    known = [f for f in facts if f["low"] is not None]
    whole |= {"low": known[0]["low"] if known else None, "high": known[-1]["high"] if known else None}
    n = len(rows)
    return pa.table(
        {
            "conv_id": table.column("conv_id").slice(0, 1).take(pa.array([0] * n)),
            "slot": pa.array([slot for slot, _ in rows], pa.int64()),
            "after": pa.array([list(v) for v in afters[n - 1 :: -1]], pa.list_(pa.int64())),
            "close": pa.array([i == n - 1 for i in range(n)], pa.bool_()),
            "cost": pa.array([None] * (n - 1) + [afters[-1][NONE]], pa.int64()),
            "facts": pa.array([None] * (n - 1) + [[whole.get(c) for c in FACTS[:7]]], pa.list_(pa.int64())),
        }
    )


_WAYS = "conv_id long, slot long, entry int, leave int, seq long, rid long, as_role string, audit string"


def _ways(table: pa.Table) -> pa.Table:
    """Of one open fragment: its edits for each state it may begin in, and the state in which each way ends."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("seq", "rid", "symbol", "n"))))
    conv_id, slot, after, close = (table.column(c)[0].as_py() for c in ("conv_id", "slot", "after", "close"))
    done = []
    for entry in range(4):
        out = _Out()
        audit, leave = _edits(out, conv_id, slot, [r[1:] for r in rows], entry, tuple(after), close)
        place = {c: i for i, c in enumerate(_TABLE)}
        done += [(conv_id, slot, entry, None, r[place["seq"]], r[place["rid"]], r[place["as_role"]], None) for r in out.rows]
        done.append((conv_id, slot, entry, leave, None, None, None, audit))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _WAYS.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)


def _chain(table: pa.Table) -> pa.Table:
    """The state in which each fragment of one conversation begins."""
    leave = {(s, e): x for s, e, x in zip(*(table.column(c).to_pylist() for c in ("slot", "entry", "leave")))}
    state, slots, entries = NONE, sorted({s for s, _ in leave}), []
    for slot in slots:
        entries.append(state)
        state = leave[slot, state]
    return pa.table({"slot": pa.array(slots, pa.int64()), "entry": pa.array(entries, pa.int32())})


# ---- the operator


def _said(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions on all rows, as stored tables.

    summary: conv_id, blank, duplicate, truncated, illegal, turns, low, high (distinct, least and greatest turns), cost
    and audit of each conversation. edits: conv_id, slot, seq (order of the repaired rows), rid, as_role: a kept row has
    no as_role, an inserted one no rid. rows: rid, role, text of the input.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = stage_table(
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
        .withColumn("said", _said(F.col("role"), F.col("text")))
        .withColumn("rid", F.monotonically_increasing_id())
    )
    is_blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    initial = F.substring("role", 1, 1)
    code = F.when(F.length("role") == 0, 0)
    for letter, number in INITIALS.items():
        code = code.when(initial == letter, number)
    counted = stage_table(
        rows.select(
            "conv_id", "turn", "role", "said", "rid", code.otherwise(0).alias("initial"), is_blank.alias("blank"),
            (~is_blank & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off"),
        )
        .groupBy("conv_id", "turn", "role", "said")
        .agg(F.min("rid").alias("rid"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("initial", "blank", "cut_off")])
    )
    first = counted.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(F.min(F.struct("turn")).alias("first"))
    seen = counted.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")))
    later = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    ordered = (
        stage_table(seen.withColumn("later", later).drop("c", "s", "first"))
        .repartitionByRange("conv_id", "turn", "role", "said")
        .sortWithinPartitions("conv_id", "turn", "role", "said")
        .select("conv_id", "rid", "turn", "initial", "n", "blank", "cut_off", "later")
    )
    parts = stage_table(ordered.mapInArrow(_fragments, _SCHEMA))
    # At most two rows for each partition.
    ends = stage_table(parts.filter(f"kind = {OPEN_END}").groupBy("conv_id").applyInArrow(_join_ends, _ENDS))
    open_rows = parts.filter(f"kind = {OPEN_ROW}").select("conv_id", "slot", "seq", "rid", "symbol", "n")
    ways = stage_table(
        open_rows.join(if_few(ends.select("slot", "after", "close")), "slot").groupBy("slot").applyInArrow(_ways, _WAYS)
    )
    taken = stage_table(
        ways.filter("leave IS NOT NULL").select("conv_id", "slot", "entry", "leave").groupBy("conv_id").applyInArrow(_chain, "slot long, entry int")
    )
    own = ways.join(if_few(taken), ["slot", "entry"])
    edits = parts.filter(f"kind = {EDITED}").select("conv_id", "slot", "seq", "rid", "as_role")
    edits = edits.unionByName(own.filter("leave IS NULL").select("conv_id", "slot", "seq", "rid", "as_role"))
    audits = (
        own.filter("leave IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "audit"))).alias("pieces"))
        .select(F.col("conv_id").alias("c"), F.array_join(F.transform("pieces", lambda x: x["audit"]), "").alias("audit"))
    )
    whole = ends.filter("close").select("conv_id", "cost", "facts").join(audits, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    solved = parts.filter(f"kind = {SOLVED}").select("conv_id", F.get("facts", F.lit(len(FACTS))).alias("cost"), "facts", "audit")
    facts = [F.get("facts", F.lit(i)).alias(c) for i, c in enumerate(FACTS[:7])]
    summary = solved.unionByName(whole).select("conv_id", *facts, "cost", "audit")
    return summary, edits, rows.select("rid", "role", "text")


def repaired_rows(edits: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, slot, seq (their order), role, text."""
    own = edits.join(rows, "rid", "left")
    return own.select("conv_id", "slot", "seq", F.coalesce("as_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _hashes(source):
    conv_id, state, began = None, None, False
    out = []
    for batch in source:
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if not began or c != conv_id:
                if began:
                    out.append((conv_id, state.hexdigest()))
                conv_id, state, began = c, sha256(), True
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.string()))], names=["c", "sha"])
            out = []
    if began:
        yield pa.RecordBatch.from_arrays([pa.array([conv_id], pa.int64()), pa.array([state.hexdigest()])], names=["c", "sha"])


def texts_sha256(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines `role:text`, joined by line feeds: c, sha. One batch is held at a time."""
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "slot", "seq")
    return ordered.select("conv_id", "role", "text").mapInArrow(_hashes, "c long, sha string")


def reports(conversations: DataFrame) -> DataFrame:
    """One row for each conversation that has rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    summary, edits, rows = repair(conversations)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    out = summary.join(texts_sha256(repaired_rows(edits, rows)), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    sha = F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return out.select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", sha)
