"""The rows of a mix hold what its decisions say: as many words as are taken, in training order."""

import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tessera.llm import common, mixing, pieces

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(6)
    rows = []
    for i in range(90):
        n = 30_000 if i == 41 else r.randrange(1, 60)
        t = r.choice(["", " ", "\n"]) + "".join(f"w{r.randrange(999)}{r.choice([' ', '  ', chr(10), chr(9)])}" for _ in range(n))
        rows.append((i, t, "en", None if i % 31 == 0 else f"s{i % 5}", len(t)))
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_first_words_keep_the_spelling(spark):
    cases = [("a b c", 2, "a b"), (" \n a\t b\n\nc ", 2, " \n a\t b"), ("a", 1, "a"), ("a\x0bb  ", 2, "a\x0bb"), ("é 🙂\x85x y", 2, "é 🙂\x85x")]
    df = spark.createDataFrame([(t, n, w) for t, n, w in cases], "t string, n long, want string")
    got = df.select(common.first_words(F.col("t"), F.col("n")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_rows_have_the_words_that_are_taken(spark, docs):
    plan = mixing.stream(mixing.assign(docs)).collect()
    whole = {r.doc_id: r.text for r in docs.collect()}
    out = mixing.mix_rows(docs)
    assert out.columns == docs.columns and not re.search("Python|Arrow", out._jdf.queryExecution().toString())
    got = out.collect()
    assert any(p.words < p.size for p in plan) and len(got) == len(plan)
    for row, p in zip(got, plan):
        assert row.doc_id == p.doc_id and words(row.text) == words(whole[p.doc_id])[: p.words]
        assert whole[p.doc_id].startswith(row.text) and row.n_chars == len(row.text)
        assert p.words < p.size or row.text == whole[p.doc_id]


def test_run_ends_in_training_order(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "STAGES", C.STAGES[-2:])
    docs.filter("doc_id <> 41").write.parquet(str(tmp_path / "documents.parquet"))
    mixed = mixing.mix_rows(docs.filter("doc_id <> 41")).collect()
    model = pieces.Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = C.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.doc_id for r in got] == [r.doc_id for r in mixed]
    assert [r.score for r in got] == [model.encode(r.text, 1)[0][0] for r in mixed]
