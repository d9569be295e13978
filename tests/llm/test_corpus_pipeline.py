"""Each stage of the pipeline against a brute-force version on a small table."""

import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest

import corpus_pipeline as C
from tessera.llm import jaccard_join, mixing, pieces, quality_rules
from tests.llm.test_jaccard_join import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(4)
    words = ["the", "of", "and"] + [f"v{i}" for i in range(500)]
    rows = []
    for i in range(160):
        kind = i % 8
        w = [r.choice(words[:3]) if r.random() < 0.2 else r.choice(words) for _ in range(r.randrange(12, 90))]
        if kind == 1:
            w = [x + "***" for x in w]
        if kind == 2 and rows:
            w = (r.choice(rows)[1] or "x").split(" ")
        if kind == 3 and rows:
            w = (r.choice(rows)[1] or "x").split(" ")
            w[-1] = "last"
        if kind == 4:
            w = w[:5]
        rows.append((i, None if i == 13 else " ".join(w), "en", None if i % 31 == 0 else f"s{i % 5}", len(w)))
    return spark.createDataFrame(rows, SCHEMA)


def stage(name):
    return dict(C.STAGES)[name]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_names_and_order():
    assert [k for k, _ in C.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing", "SentencePiece encoding"]


def test_quality_rules(spark, docs):
    out = stage("quality rules")(spark, docs, "")
    assert out.columns == docs.columns
    want = []
    for row in rows_of(docs):
        w = (row[1] or "").split()
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
        stops = sum(x in quality_rules.STOP_WORDS for x in w)
        symbols = len(re.findall(r"[#*$%&|<>]", row[1] or ""))
        bad = len(w) < 10 or 100 * len(covered) > 20 * len(w) or symbols > 0.1 * len(w)
        bad = bad or not 2 * len(w) <= sum(map(len, w)) <= 12 * len(w) or (len(w) >= 30 and stops < 0.04 * len(w))
        if not bad:
            want.append(row)
    assert 0 < len(want) < 160 and Counter(rows_of(out)) == Counter(want)


def test_exact_dedup(spark, docs):
    best = {}
    for row in rows_of(docs):
        key = row[1] or ""
        if key not in best or row[0] > best[key][0]:
            best[key] = row
    out = stage("exact dedup")(spark, docs, "")
    assert out.columns == docs.columns and len(best) < 160
    assert Counter(rows_of(out)) == Counter(best.values())


def test_near_copies(spark, docs):
    rows = rows_of(docs)
    classes = brute([r[:2] for r in rows])
    want = [r for r in rows if r[0] in {min(c for _, c in classes[r[0]])}]
    out = stage("n-gram Jaccard join")(spark, docs, "")
    assert out.columns == docs.columns and len(want) < 160
    assert Counter(rows_of(out)) == Counter(want)


def test_mixing(spark, docs):
    import hashlib

    rows = rows_of(docs)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted([k for k in by if k is not None]) + [None]
    total = {k: sum(size[r[0]] for r in by[k]) for k in names}
    weight = {k: mixing.WEIGHTS[i % 3] for i, k in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    rest = float(sum(total.values()))
    while rest > 1e-6:
        w = sum(weight[k] for k in open_)
        share = {k: rest * weight[k] / w for k in open_}
        rest = 0.0
        for k in list(open_):
            target[k] += share[k]
            if target[k] > 3 * total[k]:
                rest += target[k] - 3 * total[k]
                target[k] = 3.0 * total[k]
                open_.discard(k)
    want = Counter()
    for k in names:
        quota, start = int(target[k] + 0.5), 0
        for r in sorted(by[k], key=lambda r: hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()):
            n = size[r[0]]
            for p in range(3) if n else ():
                words = min(n, quota - p * total[k] - start)
                if words == n:
                    want[r] += 1
                elif words > 0:
                    # The take in which the quota ends holds the words that are taken, as they are written.
                    text = r[1][: [m.end() for m in re.finditer("[^\x20\x09-\x0d]+", r[1])][words - 1]]
                    want[(r[0], text, *r[2:4], len(text))] += 1
            start += n
    out = stage("mixing")(spark, docs, "")
    assert out.columns == docs.columns
    assert Counter(rows_of(out)) == +want


def test_encoding(spark, docs):
    model = pieces.Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in stage("SentencePiece encoding")(spark, docs, "").collect()}
    assert len(got) == 160
    for doc_id, text, *_ in rows_of(docs):
        want = model.search("▁" + text.replace(" ", "▁"), 1)[0] if text else (0.0, ())
        assert got[doc_id].score == want[0] and got[doc_id].round_trip


def test_run_equals_the_stages(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    step = docs
    for _, f in C.STAGES:
        step = f(spark, step, str(tmp_path))
    key = lambda df: Counter(map(str, df.collect()))
    assert key(C.run(spark, str(tmp_path))) == key(step)
