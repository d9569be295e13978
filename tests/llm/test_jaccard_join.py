import random
import re

import pytest

from tessera.llm import jaccard_join as J


def brute(rows):
    """Components by comparing all pairs of sets."""
    sets, out = [], {}
    for doc_id, text in rows:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
        s = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
        sets.append(s)
    n = len(rows)
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(n):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 85 * (len(sets[i]) + len(sets[j]) - c):
                top[find(i)] = find(j)
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        out.setdefault(rows[i][0], set()).add((len(sets[i]), min(ids, default=None)))
    return out


def corpus(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, line = [], " ".join(r.choices(vocab, k=30))
    bases = [r.choices(vocab, k=r.choice([3, 5, 9, 12, 15, 18, 22, 30, 60, 150])) for _ in range(n // 8)]
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            k = r.randrange(len(w))
            w[k : k + r.choice([0, 1])] = r.choices(vocab, k=r.choice([0, 1]))
            w = w or ["x"]
        t = " ".join(x.upper() if r.random() < 0.1 else x for x in w)
        rows.append((i * 7 % n, t + ("\n" + line if r.random() < 0.2 else "")))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = corpus(seed, 400)
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) in want[r.doc_id]


def test_nulls_blanks_repeats_and_clashing_columns(spark):
    text = "a b c d e f g"
    rows = [(1, None, 9), (2, "", 9), (3, " \n", 9), (None, text, 9), (5, text, 9), (5, text, 9), (6, "a b", 9), (7, "A B", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in J.join(df).collect())
    assert got == [(-1, 4, 5), (1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 4, 5), (5, 4, 5), (6, 1, 6), (7, 1, 6)]
    assert J.join(df.limit(0)).count() == 0
    assert sorted(r.doc_id for r in J.keep_rows(df).collect()) == [1, 2, 3, 5, 6]


def test_subsets_cover_every_linked_pair_of_sizes():
    for b in (6, 13, 20):
        for n in range(1, 31):
            for m in range(n, n * 100 // 85 + 1):
                if n <= b and J.need(n, m) <= n:
                    assert J.need(n, m) in J.subset_sizes(n, b) and J.need(n, m) in J.subset_sizes(m, b)


def test_sketches_bound_the_overlap():
    import numpy as np

    r = np.random.default_rng(0)
    for _ in range(200):
        pool = r.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
        a, b = (np.unique(r.choice(pool, r.integers(16, 250))) for _ in range(2))
        if len(a) >= 16 and len(b) >= 16:
            assert J.overlap_bound(J.sketch(a), J.sketch(b)) >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("rounds,block", [(0, 8), (2, 8)])
def test_long_lists_by_stars_and_blocks(spark, monkeypatch, rounds, block):
    """A group of near copies of which many do not link; each path alone and both together equal all pairs."""
    for name, value in {"LONG_LIST": 4, "STAR_ROUNDS": rounds, "BLOCK": block}.items():
        monkeypatch.setattr(J, name, value)
    r = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(6)):
            w[r.randrange(60)] = f"e{r.random()}"
        rows.append((100 - i, " ".join(w)))
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert all((x.n_shingles, x.component_id) in want[x.doc_id] for x in got) and len(got) == 60
    assert len({x.component_id for x in got}) > 3


def test_patterned_words_stay_apart(spark):
    word = "".join("ab"[i.bit_count() % 2] for i in range(1 << 11))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([word] * 9)), (2, " ".join([other] * 9)), (3, word), (4, other)]
    got = {x.doc_id: x.component_id for x in J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}


def test_kept_rows_carry_any_columns(spark):
    schema = "doc_id long, text string, uid string, nth int, row map<string,int>, text_key int"
    rows = [
        (1, "a b c d e f", "U1", 7, {"k": 1}, 3),
        (1, "a b c d e f", "U2", 8, {"k": 2}, 3),
        (2, "a b c d e f", "U3", 9, None, 3),
        (None, "other words of a text", "U4", 1, None, 3),
        (None, "words that link with nothing else", "U5", 2, {"k": 5}, 3),
        (1, "one id and another text", "U6", 3, None, 3),
        (None, None, "U7", 4, None, 3),
        (None, None, "U8", 5, None, 3),
    ]
    kept = J.keep_rows(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "uid", "nth", "row", "text_key"]
    got = {x.uid: x for x in kept.collect()}
    assert len(got.keys() & {"U1", "U2"}) == 1 and set(got) - {"U1", "U2"} == {"U4", "U5", "U6", "U7", "U8"}
    assert got["U5"].nth == 2 and got["U5"].row == {"k": 5}
