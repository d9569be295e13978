import heapq
import random
import re
from hashlib import sha256

import pytest

from tessera.llm import structure_repair as S

WORD = re.compile("[^\x20\x09-\x0d]")


def brute(rows):
    """Facts, cost, audit and text of the rows (turn, role, text) of one conversation, by a shortest path over places and states."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    said = lambda r: sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], said(r)))
    seen, faults = set(), []
    for _, role, text in rows:
        marks = WORD.findall(text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, *_ in rows if t is not None}
    initials = [r[1][:1] for r in rows]
    facts = (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
    )
    follow, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, q, out = heapq.heappop(queue)
        if i == len(rows) and q in ("", "a"):
            return (*facts, cost, audit, sha256("\n".join(out).encode()).hexdigest())
        if (i, q) in done:
            continue
        done.add((i, q))
        heapq.heappush(queue, (cost + 5, audit + "I", i, follow[q], (*out, names[follow[q]] + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, q, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                heapq.heappush(queue, (cost + 1 + more, audit + "R", i + 1, follow[q], (*out, f"{names[follow[q]]}:{text}")))
                if role[:1] == follow[q] or (role[:1], q) == ("s", ""):
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "u", "", None, "User", "a2"]
TEXTS = ["Yes.", "No!", "Go on", "", " \n", None, "Why?\n", "end.\x0b ", "é", "…", "x.\x1c", "　"]


def rows_of(r, n, turns):
    return [(r.choice(turns), r.choice(ROLES), r.choice(TEXTS) if r.random() < 0.4 else f"w{r.randrange(10**6)}{r.choice(['.', '!', ''])}") for _ in range(n)]


@pytest.mark.parametrize("parts", [1, 8])
def test_reports_match_a_shortest_path(spark, parts):
    r = random.Random(parts)
    talks = {c: rows_of(r, r.randrange(1, 25), [*range(-2, 12), None]) for c in range(60)}
    talks[None] = rows_of(r, 40, [None])
    talks[100] = rows_of(r, 900, range(300))  # reaches over several partitions
    talks[101] = [(3, "user", "Same.")] * 500 + [(4, "assistant", "Same.")] * 3 + [(t, "user", f"{t}!") for t in range(10, 300)]
    rows = [(c, *x, 1, "n") for c, xs in talks.items() for x in xs]
    r.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false" if parts > 1 else "true")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rid int, said string")
        got = {x[0]: tuple(x)[1:] for x in S.reports(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.keys() == talks.keys()
    for c, xs in talks.items():
        assert got[c] == brute(xs), c


def test_powers_are_repeated_products():
    for symbol in range(9):
        one, many = S.power(symbol, 0), S.IDENTITY
        for n in range(1, 20):
            many = S.times(many, one)
            assert S.run_matrix([(symbol, n)]) == many


def test_repaired_rows_are_sound_and_empty_input_gives_none(spark):
    r = random.Random(9)
    rows = [(c, *x) for c in range(30) for x in rows_of(r, 9, range(12))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    summary, edits, texts = S.repair(df)
    got = {}
    for x in S.repaired_rows(edits, texts).orderBy("conv_id", "slot", "seq").collect():
        got.setdefault(x.conv_id, []).append(x.role[:1])
    assert all(re.fullmatch("s?(ua)+", "".join(v)) for v in got.values()) and len(got) > 20
    assert summary.count() == 30
    assert S.reports(df.limit(0)).count() == 0
