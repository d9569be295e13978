import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tessera.llm import simhash as S
from tessera.llm.components import components


def plain_fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts_of(r, n):
    vocab = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]
    out = ["", None, " \n\t", "one", "One two", "one two", "a\x0b\x0cb  c", "x\x1cy z q", "a b a b a b a b a b"]
    while len(out) < n:
        base = r.choices(vocab, k=r.choice([1, 2, 3, 5, 40, 200]))
        for _ in range(r.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(r.choice([0, 1, 2])):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append(r.choice([" ", "\n", "  "]).join(w) + r.choice(["", " "]))
    return out[:n]


def test_fingerprints_match_their_definition():
    texts = texts_of(random.Random(1), 300)
    assert S.fingerprints(pa.array(texts, pa.string())).tolist() == [plain_fingerprint(t) for t in texts]
    assert S.fingerprints(pa.array([], pa.string())).tolist() == []
    assert S.fingerprints(pa.array(["", None])).tolist() == [0, 0]


def smallest_ids(rows):
    """Component of each row, by comparing all pairs."""
    fps = [f for _, f in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    values = np.array(fps, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3).tolist():
            top[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(rows))]


def test_components_match_all_pairs_on_documents(spark):
    r = random.Random(2)
    texts = texts_of(r, 500)
    ids = [r.choice([i, i, i, None, 7]) for i in range(len(texts))]
    rows = [(d, plain_fingerprint(t)) for d, t in zip(ids, texts)]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, smallest_ids(rows))), key=repr)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in zip(ids, texts)], "doc_id long, text string, fp int, component_id string")
    assert sorted(map(tuple, S.near_duplicates(docs).collect()), key=repr) == want
    assert S.near_duplicates(docs.limit(0)).count() == 0


def clustered(r, n):
    """Fingerprints with skewed and correlated bits, in dense groups around few centres, and scattered ones."""
    centres = [r.getrandbits(64) for _ in range(4)]
    out = {0, 1, (1 << 64) - 1}
    while len(out) < n:
        f = r.choice(centres) if r.random() < 0.7 else r.getrandbits(64) & r.getrandbits(64)
        if f & 1:
            f |= 0xF0
        for _ in range(r.randrange(12)):
            f ^= 1 << r.randrange(64)
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("parts, cell", [(2, 4096), (3, 50), (4, 4096), (4, 20)])
def test_no_link_is_lost_for_any_parts_and_cells(spark, parts, cell):
    """Small cells also go through the second split and the blocks."""
    fps = clustered(random.Random(parts), 1500)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long").repartition(4)
    if cell < 100:
        plan = S.plan_for(df, parts, cell)[0]
        assert len(plan.hot) and len(plan.hot_cells) and plan.blocks.max() > 1
    links = S.links_of(df, parts, cell).collect()
    unsigned = lambda x: x % (1 << 64)
    assert all((unsigned(x.a) ^ unsigned(x.b)).bit_count() <= 3 for x in links)
    got = {unsigned(x.node): unsigned(x.component) for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = smallest_ids([(i, f) for i, f in enumerate(fps)])
    groups = {}
    for f, c in zip(fps, want):
        groups.setdefault(c, set()).add(f)
    found = {}
    for f in fps:
        found.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))


def test_thresholds_are_the_cheapest_of_their_sum():
    r = np.random.default_rng(4)
    plan = S.Plan([list(range(i, 64, 4)) for i in range(4)])
    plan.estimate([r.integers(0, 50, 1 << 16) * (r.random(1 << 16) < 0.1) for _ in range(4)])
    fps = r.integers(0, 1 << 63, 50).astype(np.uint64)
    values = plan.values(fps)
    got = plan.thresholds(values)
    assert (got.sum(1) == 0).all()
    ways = [t for t in np.ndindex(5, 5, 5, 5) if sum(t) == 4]
    for k in range(50):
        def cost(t):
            return sum(0 if x == 0 else plan.costs[i][x - 1, int(values[i][k])] for i, x in enumerate(t))

        assert cost(tuple(got[k] + 1)) == pytest.approx(min(map(cost, ways)))


def test_number_of_parts_falls_as_fingerprints_grow():
    chosen = [S.choose_parts(10**k) for k in range(12)]
    assert chosen == sorted(chosen, reverse=True) and chosen[0] == 4 and chosen[-1] == 2
