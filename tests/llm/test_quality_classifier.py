import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import quality_classifier as Q

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.score(docs, Q.train(docs, labels)).join(labels, "doc_id").toPandas()
    for r in got.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_descent_reaches_the_optimum_of_the_dual():
    r = np.random.default_rng(2)
    texts = ["".join(r.choice(list("abcd"), 30)) for _ in range(60)]
    y = np.array([int(t.count("a") > t.count("b")) for t in texts])
    m = Q.fit(pa.array(texts), y, epochs=3000, penalty=0.5)
    again = Q.fit(pa.array(texts), y, epochs=6000, penalty=0.5, seed=11)
    assert m.margins(pa.array(texts)) == pytest.approx(again.margins(pa.array(texts)), abs=0.05)


def test_features_are_the_distinct_ngrams_of_each_text():
    texts = ["abcabcabc", "", "ab", "é", "x" * 9000, "abc"]
    got = [len(f) for f in Q._features(pa.array(texts))]
    assert got == [3, 0, 0, 0, 1, 1]


def test_nulls_no_labels_one_class_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "good text", 1), (0, None, 2), (2, "", 3), (3, "x", 4)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score(docs, Q.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 0) for i in range(9)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = Q.score(docs, Q.train(docs, one)).collect()
    assert len(rows) == 4 and {r.predicted for r in rows} == {0}
    assert not [r for r in rows if r.doc_id is None and r.held_out]
    assert Q.score(docs.limit(0), Q.train(docs, none)).count() == 0


def test_a_class_of_long_texts_is_learnt_from(spark):
    long, short = "good words " * 3000, "bad stuff here"
    rows = [(3 * i, (long if i % 2 else short) + f" {i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(t.startswith("good"))) for d, t in rows], "doc_id long, quality int")
    got = Q.score(docs, Q.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.predicted == r.quality for r in got)
