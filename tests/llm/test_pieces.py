import random
import time

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return P.Lattice(PATH, remembered=50)


def all_segmentations(model, text):
    """Every segmentation by recursion."""
    edges, memo = model.edges(text), {0: [(0.0, ())]}
    for j in range(1, len(text) + 1):
        memo[j] = [(s + score, head + ids) for i, score, ids in edges[j] for s, head in memo[i]]
    return sorted(memo[len(text)], key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("word", ["▁the", "▁thereof", "▁éauxmenté", "▁日\nx", "▁▁ in", "a"])
def test_search_equals_enumeration(model, word):
    every = all_segmentations(model, word)
    for n in (1, 2, 5, 40):
        got = model.search(word, n)
        assert [s for s, _ in got] == pytest.approx([s for s, _ in every[:n]])
        assert {x for _, x in got} <= {x for _, x in every} and len(set(got)) == len(got)


def test_best_and_second_best_of_many_stretches(model, monkeypatch):
    words = ["▁the", "▁thereof", "▁éauxmenté", "▁日", "\nx,", "▁aaaaaaa", "a", "▁🙂z", "▁▁ in"]
    for long in (2000, 4):
        monkeypatch.setattr(P, "LONG", long)
        ids, at, score, cost = model.segment(words)
        for k, word in enumerate(words):
            every = all_segmentations(model, word)
            assert score[k] == pytest.approx(every[0][0])
            assert tuple(ids[at[k] : at[k + 1]].tolist()) in {x[1] for x in every if x[0] == pytest.approx(every[0][0])}
            assert cost[k] == pytest.approx(every[0][0] - every[1][0] if len(every) > 1 else float("inf"))


def test_whole_texts_equal_one_lattice(model):
    r = random.Random(3)
    for _ in range(60):
        text = " ".join(r.choice(["the", "ée", "in", "x\ny", "", "of,", "Zq"]) for _ in range(r.randrange(1, 5)))
        if not text:
            continue
        whole = "▁" + text.replace(" ", "▁")
        for n in (1, 2, 4, 7):
            got = [s for s, _ in model.encode(text, n)]
            assert got == pytest.approx([s for s, _ in model.search(whole, n)]), (text, n)
        found = model.encode(text, 5)
        assert len({x.tobytes() for _, x in found}) == len(found)
        weights = {i: w for i, w in model.pieces.values()}
        for s, x in found:
            assert model.decode(x.tolist()) == text and s == pytest.approx(sum(weights.get(i, model.floor) for i in x.tolist()))


def test_many_texts_equal_one_by_one(model, monkeypatch):
    texts = ["the of and", "", "a  b", "x\ny z", " lead", "the of and the", "Éré\n\nñandú"] * 3
    apart = [[(s, x.tolist()) for s, x in model.encode(t, 3)] for t in texts]
    monkeypatch.setattr(P, "TOGETHER", 8)
    assert [[(s, x.tolist()) for s, x in f] for _, f in model.encode_all(texts, 3)] == apart


def test_agreement_with_the_library(spark):
    """Words are cut as the model's own merges cut them for the most part, and into no more pieces."""
    model, library = P.Lattice(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    words = [w for r in docs for w in (r.text or "").split()]
    distinct = list(set(words))
    ours = {w: found[0][1].tolist() for w, (_, found) in zip(distinct, model.encode_all(distinct, 1))}
    theirs = dict(zip(distinct, library.encode(distinct)))
    agreed = sum(ours[w] == theirs[w] for w in words) / len(words)
    assert agreed > 0.75 and sum(len(ours[w]) for w in words) <= 1.02 * sum(len(theirs[w]) for w in words)
    assert [library.id_to_piece(i) for i in model.encode("the of and", 1)[0][1].tolist()] == ["▁the", "▁of", "▁and"]


def test_decoding_equals_the_library_and_round_trips(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["", None, "the of and", " lead  double ", "Éré\nñandú\tß", "日本 🙂 x", "a" * 4000, "▁x", "\n", " "]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in P.encode(df, PATH, 3).collect()}
    for i, t in enumerate(texts):
        best = got[i].segmentations[0]
        assert got[i].n_pieces == len(best) and got[i].scores[0] == got[i].score
        if t and "▁" not in t:
            assert library.decode(best) == t and model.decode(best) == t
        assert got[i].round_trip == ("▁" not in (t or ""))
    back = P.decode(P.encode(df, PATH, 1).select("doc_id", F.col("segmentations")[0].alias("ids")), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert P.encode(df.limit(0), PATH).count() == 0


def test_long_stretches_change_nothing_for_others(model):
    r = random.Random(8)
    words = [P.SPACE + "".join(r.choices("abcdeéß漢\U0001f600", k=r.randrange(1, 9))) for _ in range(300)]
    longs = [P.SPACE + "".join(r.choices("abc é".replace(" ", ""), k=n)) for n in (P.LONG + 1, 5000)]
    mixed = [*words[:100], longs[0], *words[100:], longs[1]]
    ids, ends, score, margin = model.segment(mixed)
    for k, stretch in enumerate(mixed):
        one = model.segment([stretch])
        assert ids[ends[k] : ends[k + 1]].tolist() == one[0].tolist()
        assert (score[k], margin[k]) == (one[2][0], one[3][0])


def test_one_very_long_word_is_cheap(model):
    r = random.Random(9)
    words = list({P.SPACE + "".join(r.choices("abcdefghij", k=7)) for _ in range(20_000)})
    began = time.process_time()
    model.segment(words)
    plain = time.process_time() - began
    began = time.process_time()
    model.segment([*words, P.SPACE + "x" * 2000])
    assert time.process_time() - began < 2 * plain + 1
    began = time.process_time()
    model.segment([P.SPACE + "ab" * 100_000])
    assert time.process_time() - began < 15
