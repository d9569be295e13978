"""Golden examples of the functions, and properties of the joins."""

import itertools
import json
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsonx, keys, text
from tessera.operators import enrich, merge, passjoin, rank, similarity


def values(df):
    return [tuple(r) for r in df.collect()]


def test_uuid5_equals_the_standard(spark):
    seeds = ["a|b|c", "", "Ünïcode|x"]
    got = values(spark.createDataFrame([(s,) for s in seeds], "s string").select("s", keys.uuid5(F.col("s"))))
    assert got == [(s, str(uuid.uuid5(uuid.NAMESPACE_OID, s))) for s in seeds]


def test_text_functions(spark):
    df = spark.createDataFrame([("  Metformin Hydrochloride ", "word two 250 mg"), ("Sodium", "x"), (None, None)], "a string, b string")
    amount, unit = text.strength(F.col("b"))
    got = values(df.select(text.strip_suffix(F.col("a"), text.SALTS), amount, unit, text.token_sort(F.col("b")), text.squeeze(F.col("a"))))
    assert got[0] == ("METFORMIN", 250.0, "MG", "250 mg two word", "Metformin Hydrochloride")
    assert got[1] == ("SODIUM", None, None, "x", "Sodium") and got[2] == (None,) * 5


def test_trigram_similarity_of_the_known_example(spark):
    a, b = (spark.createDataFrame([(x,)], "x string") for x in ("word", "two words"))
    assert values(similarity.trigram_join(a, b, "x", "x", 0.1)) == [("word", "two words", pytest.approx(4 / 11))]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_join_loses_no_pair(spark, most):
    r = random.Random(most)
    names = sorted({"".join(r.choices("ab", k=r.randrange(1, 16))) for _ in range(80)})
    df = spark.createDataFrame([(n,) for n in names], "x string")
    got = {(a, b) for a, b, _ in values(passjoin.edit_join(df, df, "x", "x", most))}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row, old = [i], row
            for j, d in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (c != d)))
        return row[-1]

    assert got == {(a, b) for a, b in itertools.product(names, names) if distance(a, b) <= most}


def read_objects(text):
    """The complete objects of a cut-off array, by the standard decoder."""
    body = re.sub(r"^\s*```\w*|```\s*$", "", text.strip())
    decoder, found, at = json.JSONDecoder(), [], body.find("{")
    whole = body.find("[")
    if 0 <= whole and (at < 0 or whole < at):
        try:
            return decoder.raw_decode(body, whole)[0]
        except ValueError:
            pass
    while at >= 0:
        try:
            value, end = decoder.raw_decode(body, at)
        except ValueError:
            break
        found.append(value)
        at = body.find("{", end)
    return found or None


def test_json_gaps_and_repair(spark):
    gaps = spark.createDataFrame([(x,) for x in (None, "", '"  "', "[]", "{ }", "null", "0", "false", "[0]", '"[]"', '"null"')], "j string")
    assert [r[0] for r in values(gaps.select(jsonx.is_blank(F.col("j"))))] == [True] * 6 + [False] * 5
    r = random.Random(1)
    whole = json.dumps([{"a": "x}{", "b": [1, {"c": '"}'}]}, {"d": "\\", "e": {"f": []}}, {"g": "[é", "h": None}])
    texts = [whole[: r.randrange(len(whole) + 1)] for _ in range(120)] + [whole + "\n```", "```json\n" + whole + "\n```", "Here: " + whole + " done [1]"]
    texts += ["none", "", "[1, 2]", "[]", "{}", '{"a": 1} {"b": tru} {"c": 2}', "[{]}", '{"a": 1}{"a": 2', "[1, 2", "  ", "{" * 50, '{"a":"' + "\\" * 7]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", jsonx.repaired(F.col("t")).alias("j"))
    assert "Python" not in df._jdf.queryExecution().toString()
    for t, j in values(df):
        assert (None if j is None else json.loads(j)) == read_objects(t), t


def cut(x, size):
    out, at = [], 0
    while at < len(x):
        end = at + size
        if end < len(x):
            feed = x.rfind("\n", at, end)
            end = feed + 1 if feed > at else end
        out.append(x[at:end])
        at = end
    return out


def test_chunks_equal_the_greedy_program(spark):
    r = random.Random(1)
    texts = ["".join(r.choice("aé \n" if r.random() < 0.5 else "ab") for _ in range(r.randrange(200))) for _ in range(150)] + ["", None, "\n" * 40, "x" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for size in (1, 17, 60):
        assert [list(c or []) for c, in values(df.select(text.chunks(F.col("t"), size)))] == [cut(t or "", size) for t in texts]


def test_fill_decisions_and_application_agree(spark):
    rows = [(1, "g", None), (2, "g", "ab"), (3, "g", "abc"), (4, "g", "xyz"), (5, "h", " ")]
    df = spark.createDataFrame(rows, "id int, g string, v string")
    decided = enrich.sibling_decisions(df, ["g"], "id", "v")
    assert sorted(values(decided)) == [(1, "abc", 3, "filled"), (5, None, None, "skipped")]
    assert sorted(values(enrich.apply_decisions(df, decided, "id", "v")))[0] == (1, "g", "abc")


def test_merges_and_ranks(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(1, None, 7), (3, "c", 3)], "k int, s string, n int")
    assert sorted(values(merge.upsert(old, new, ["k"]))) == [(1, "a", 7), (2, "b", 2), (3, "c", 3)]
    assert sorted(r[0] for r in values(merge.insert_ignore(old, new, ["k"]))) == [1, 2, 3]
    assert sorted(values(merge.fill_nulls(old, new, ["k"], "n"))) == [(1, "a", 7), (2, "b", 2)]
    nulls = spark.createDataFrame([(None,), (1,)], "x int")
    assert values(merge.not_in(old.select("k"), "k", nulls, "x")) == [(2,)]
    votes = spark.createDataFrame([("u", "b"), ("u", "a"), ("u", None), ("v", "c")], "u string, x string")
    assert sorted(values(rank.vote(votes, ["u"], "x").select("u", "x", "votes"))) == [("u", "a", 1), ("v", "c", 1)]
