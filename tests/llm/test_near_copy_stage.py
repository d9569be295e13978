"""The pipeline's near-copy stage with its own width of 5 words and share of 0.8, against all pairs."""

import random

import corpus_pipeline as C

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Words of a document and how many of them a near copy replaces, spread evenly.
EDITS = ((50, 1), (100, 2), (200, 4), (500, 11), (1000, 21))


def shingles(text):
    w = text.split(" ")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near(x, y):
    a, b = shingles(x), shingles(y)
    return 10 * len(a & b) >= 8 * len(a | b)


def test_near_copies_of_every_length_go(spark):
    r = random.Random(5)
    texts = []
    for n, edits in EDITS:
        base = [f"v{r.randrange(100_000)}" for _ in range(n)]
        for k in (0, edits, 2 * edits):
            w = list(base)
            for i in range(k):
                w[(2 * i + 1) * n // (2 * k)] = f"new{i}"
            texts.append(" ".join(w))
    for i in range(0, len(texts), 3):
        assert near(texts[i], texts[i + 1]) and not near(texts[i], texts[i + 2])
    want, top = [], {}
    for i, t in enumerate(texts):
        top[i] = next((top[j] for j in range(i) if near(texts[j], t)), i)
        if top[i] == i:
            want.append(i)
    assert len(want) < len(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    out = dict(C.STAGES)["n-gram Jaccard join"](spark, docs, "")
    assert sorted(x.doc_id for x in out.collect()) == want
