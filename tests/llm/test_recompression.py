import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import recompression as R
from tessera.llm import tokens


def brute(rows, width):
    docs = [[w for w in re.split("[\x20\x09-\x0d]+", t or "") if w] for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in docs for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, docs):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return Counter(out)


def corpus(seed, n, words):
    """Texts of few words, so that runs and periods abound, with shared passages cut at all places."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    passage = r.choices(vocab, k=120)
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(4)):
            kind = r.randrange(5)
            a = r.randrange(100)
            if kind == 0:
                parts += passage[a : a + r.randrange(80)]
            elif kind == 1:
                parts += [r.choice(vocab)] * r.randrange(60)
            elif kind == 2:
                parts += r.choices(vocab, k=3) * r.randrange(20)
            else:
                parts += [f"u{r.random()}" if r.random() < 0.3 else r.choice(vocab) for _ in range(r.randrange(60))]
        rows.append((i, r.choice([" ", "\n", "  "]).join(parts)))
    return rows


@pytest.mark.parametrize("seed,words,chunk", [(1, 3, 6 << 20), (2, 40, 700), (3, 400, 700)])
def test_removal_matches_all_windows(spark, monkeypatch, seed, words, chunk):
    monkeypatch.setattr(R, "CHUNK_BYTES", chunk)
    rows = corpus(seed, 80, words)
    got = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows, R.WIDTH)
    assert sum(x[2] > 0 for x in want) > 10
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == want


def test_symbols_and_windows_of_equal_passages_agree():
    """Without answers nothing closes; a settled symbol stands wherever its passage does."""
    for seed in range(8):
        texts = [t for _, t in corpus(seed, 60, [2, 3, 10, 100][seed % 4])]
        chunk = R.Chunk(pa.table({"text": texts}), R.WIDTH, 4)
        chunk.rise(R.ROUNDS[-1])
        level, (a, b) = chunk.level, tokens.windows(chunk.lanes, R.WIDTH)
        inside = np.flatnonzero(level.inside(R.WIDTH, len(chunk.lanes)))
        held = {}
        for i in np.flatnonzero(chunk.open).tolist():
            mine = inside[(level.low[inside] >= i) & (level.high[inside] <= i + R.WIDTH)]
            symbols = [(int(level.low[s]) - i, int(level.name[s])) for s in mine]
            assert held.setdefault((int(a[i]), int(b[i])), symbols) == symbols


def test_rounds_rule_out_what_occurs_once(spark):
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(500)}" for _ in range(300)) for _ in range(20)]
    chunk = R.Chunk(pa.table({"text": texts}), R.WIDTH, 4)
    before = int(chunk.open.sum())
    for to in R.ROUNDS:
        sent = R._sent(chunk.rise(to), 0, 4)
        told = R._shared(R._NAME)(sent).to_pydict()
        chunk.close(R._told(chunk.level.name[chunk.asked].view(R._NAME), dict(zip(told["bucket"], told["shared"])), 4))
    assert chunk.open.sum() < before / 20


def thue_morse(n):
    """A word and its complement, which a polynomial modulo 2^64 cannot tell apart."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_patterned_words_stay_apart(spark):
    one, other = thue_morse(1 << 11)
    rows = [(1, " ".join([f"x{i}" for i in range(34)] + [one])), (2, " ".join([f"x{i}" for i in range(34)] + [other]))]
    rows += [(3, " ".join([one] * 20 + [other] * 15)), (4, " ".join([other] * 20 + [one] * 15))]
    got = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0] * 4
    pattern = thue_morse(64)
    docs = [" ".join("yes" if c == "a" else "no" for c in p) for p in pattern]
    both = R.remove_repeats(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in both.collect()) == brute(list(enumerate(docs)), R.WIDTH)


def test_nulls_empty_repeats_and_clashing_columns(spark):
    long = " ".join(f"x{i}" for i in range(40))
    rows = [(1, None, 0), (2, "", 0), (None, long, 0), (None, long, 0), (5, "a b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in R.remove_repeats(df).collect())
    assert got == Counter({(1, 0, 0): 1, (2, 0, 0): 1, (None, 40, 40): 2, (5, 2, 0): 1})
    assert R.remove_repeats(df.limit(0)).count() == 0
