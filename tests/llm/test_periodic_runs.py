import random
from hashlib import sha256

import numpy as np
import pytest

from tessera.llm import periodic_runs as P


def brute(words, least_words=6, exponent=4):
    """All runs, by comparing words at each distance."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_words, exponent * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(r, n):
    words = [r.randrange(r.choice([1, 2, 3, 6])) for _ in range(n)]
    for _ in range(r.randrange(3)):
        a, p, k = r.randrange(n), r.randrange(1, 9), r.randrange(2, 9)
        words[a : a + p * k] = (words[a : a + p] * k)[: len(words[a : a + p * k])]
    return words


@pytest.mark.parametrize("least_words, exponent", [(6, 4), (2, 2), (6, 3)])
def test_runs_match_brute_force(least_words, exponent):
    r = random.Random(exponent)
    for _ in range(400):
        words = periodic_words(r, r.randrange(1, 70))
        got = [tuple(x) for x in P.runs_of(np.array(words), least_words, exponent).tolist()]
        assert got == brute(words, least_words, exponent)


def test_extensions_and_ranks_match_their_definition():
    r = random.Random(3)
    for _ in range(60):
        w = periodic_words(r, r.randrange(2, 40))
        tree = P.ExtensionTree([x + 1 for x in w])
        n = len(w)
        assert sorted(range(n), key=lambda i: w[i:]) == sorted(range(n), key=lambda i: tree.rank[i])
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        want = [next(k for k in range(n + 1) if i + k >= n or j + k >= n or w[i + k] != w[j + k]) for i, j in pairs]
        assert tree.lce(*map(np.array, zip(*pairs))).tolist() == want


def test_sieve_keeps_every_run_whole():
    r = random.Random(5)
    for _ in range(60):
        texts = [periodic_words(r, r.randrange(1, 60)) for _ in range(5)]
        ends = np.cumsum([0] + [len(t) for t in texts])
        got = {(a + s, n, q) for a, z in P.sieve(np.concatenate(texts), ends) for s, n, q in P.runs_of(np.concatenate(texts)[a:z]).tolist()}
        assert got == {(e + s, n, q) for e, t in zip(ends.tolist(), texts) for s, n, q in brute(t)}


def test_find_on_documents(spark):
    r = random.Random(7)
    texts = ["\t".join(f"w{x}" for x in periodic_words(r, 80)) + "\n" for _ in range(40)]
    texts += ["", " \n", None, "a " * 3000, "\x1cx\x85 " * 7, "é " * 6 + "b", "a b " * 3]
    rows = [(i % 45 if i % 9 else None, t, 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long, runs int").repartition(3)
    got = [(*x[:9], [tuple(y) for y in x[9]]) for x in P.find(docs, more=("text", "runs")).collect()]
    want = []
    for doc_id, text, *_ in rows:
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        runs = brute(words) if len(words) < 3000 else [(0, 3000, 1)]
        keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        row = (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None)
        want.append((*row, sha256(lines.encode()).hexdigest(), sha256(" ".join(keep).encode()).hexdigest(), " ".join(keep), [tuple(x) for x in runs]))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert P.find(docs.limit(0)).count() == 0


def test_repeated_tails():
    assert P.repeat_tail(None, 5) is None and P.repeat_tail(0, 0) is None
    hit = [d for d in range(500) if P.repeat_tail(d, 60) is not None]
    assert 20 < len(hit) < 90
    places = P.repeat_tail(hit[0], 60)
    assert len(places) == 60 and (places <= np.arange(60)).all()
