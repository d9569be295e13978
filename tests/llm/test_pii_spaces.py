"""Surrogates where the first candidates are too few for the entities."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import pii


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.text for r in pii.replace_entities(df).collect()}


def drawn(spark, kind, norm, attempts=12):
    df = spark.createDataFrame([(a,) for a in range(attempts)], "attempt int")
    made = pii.candidate("key", F.lit(kind), F.lit(norm), F.col("attempt"))
    return [r[0] for r in df.select("attempt", made.alias("made")).orderBy("attempt").select("made").collect()]


@pytest.mark.parametrize("kind, norm", [("email", "李@公司.a.cn"), ("email", "_@-.a.com"), ("family", "Li"), ("given", "m:Li"), ("phone", "1234567")])
def test_candidates_grow(spark, kind, norm):
    made = drawn(spark, kind, norm)
    assert len(made[-1]) > len(made[0]) and len(set(made[-4:])) == 4


def test_letters_of_any_script_are_replaced(spark):
    for made in drawn(spark, "email", "李é😀٣ё@公司ü.a.cn", 2):
        assert not re.search("[李é😀٣公司ü]", made) and made.endswith(".example.cn")
        assert re.fullmatch(r"[一-鿿][a-z][a-z][0-9][а-яё]@[一-鿿]{2}[a-z]\.example\.cn", made)


def test_addresses_that_differ_where_the_surrogate_does_not(spark):
    drawn(spark, "email", "李@公司.a.cn")
    texts = ["李@公司.a.cn", "李@公司.b.cn", "_@-.a.com", "_@-.b.com", "x " + "李@公司.a.cn"]
    probe = [drawn(spark, "email", t)[-1] for t in texts[:4]]
    assert len(set(probe)) == 4
    got = replaced(spark, texts)
    assert len(set(got.values())) == 5 and got[4] == "x " + got[0] and "李" not in "".join(got.values())


def test_more_entities_than_first_candidates(spark, monkeypatch):
    monkeypatch.setitem(pii.SYLLABLES, "latin", ["ba", "den"])
    assert len(drawn(spark, "family", "Smith")[-1]) > 2 + 4 * 3  # without growth the texts below would never end
    names = [f"Mr {a}{b}{c}" for a in "ABCDE" for b in "abcd" for c in "xyz"]
    mails = [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    got = replaced(spark, [*names, *mails, "+1 23 45 67", "123-45-6789"])
    assert len(set(got.values())) == len(names) + len(mails) + 2
    assert not set(got.values()) & {*names, *mails}
    assert re.fullmatch(r"\+\d \d\d \d\d \d\d", got[len(names) + len(mails)])


def test_grown_numbers_are_written_whole(spark):
    df = spark.createDataFrame([("+1 (22) 33 44", "199887766"), ("+1 (22) 33 44", "1998877")], "surface string, made string")
    got = [r[0] for r in df.select(pii._written(F.lit("phone"), F.col("surface"), F.col("made"))).collect()]
    assert got == ["+1 (99) 88 7766", "+1 (99) 88 77"]


def test_fixed_formats_end_with_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "MOST_ATTEMPTS", 3)
    monkeypatch.setattr(pii, "candidate", lambda key, kind, norm, attempt: F.lit("192.0.2.1"))
    with pytest.raises(RuntimeError, match="ipv4"):
        replaced(spark, ["ip 10.0.0.1", "ip 10.0.0.2"])


def test_names_keep_gender_script_and_kinship(spark):
    texts = ["Mrs Anna Weiss", "Mr Anna Weiss", "Dr Weiss", "Mr Weiss", "Mr John Weiss", "Dr John Weiss", "Señora Ana Lopez", "Señor Ana Lopez"]
    texts += ["Miss Eva Stein", "Mme Eva Stein", "Mr Παύλος Δέλτας", "Κυρία Ελένη Δέλτας", "Госпожа Анна Петрова", "Ms. Ann Armenian Mr Հակոբ Պետրոսյան"]
    got = replaced(spark, texts)
    last = {i: t.split(" ")[-1] for i, t in got.items()}
    assert len({last[i] for i in range(6)}) == 1 and last[0] != "Weiss" and last[6] == last[7] != last[0]
    first = {i: got[i].split(" ")[1] for i in (0, 1, 4, 5, 6, 7, 8, 9)}

    def of(i, script, sex):
        return any(first[i].startswith(x) for x in pii.FIRST[script, sex])

    assert of(0, "latin", "f") and of(1, "latin", "m") and first[0] != first[1] and first[4] == first[5] and of(4, "latin", "m")
    assert of(6, "latin", "f") and of(7, "latin", "m") and first[8] == first[9]
    assert re.fullmatch(r"Mr [\u0370-\u03ff]+ [\u0370-\u03ff]+", got[10]) and re.fullmatch(r"Κυρία [\u0370-\u03ff]+ [\u0370-\u03ff]+", got[11])
    assert last[10] == last[11] and re.fullmatch("Госпожа [а-яА-Я]+ [а-яА-Я]+", got[12])
    assert not any(x in t for t in got.values() for x in ("Weiss", "Lopez", "Stein", "Δέλτας", "Петрова", "Armenian", "Պետրոսյան"))


def test_many_family_names_stay_distinct(spark):
    n = 70_000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("Herr Q"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    out = pii.replace_entities(rows)
    assert out.agg(F.countDistinct("text")).first()[0] == n
    assert out.join(rows, "text").isEmpty()


def test_a_long_address_and_a_random_key(spark):
    text = "x" * 200_000 + "@mail.example.com"
    got = replaced(spark, [text])
    assert len(got[0]) == 200_000 + len(got[0]) - got[0].index("@") and got[0] != text
    assert spark.conf.get(pii.KEY_SETTING) and replaced(spark, ["ip 10.0.0.1"]) == replaced(spark, ["ip 10.0.0.1"])


def test_no_part_of_a_name_is_left(spark):
    r = random.Random(4)
    parts = "McDonald O'Brien Smith-Jones Müller-Lüdenscheidt Jean-Luc D’Angelo d'Arcangelo Picard Weißkopf SMITHERS Łukasz ÉmileZola Κωνσταντίνου Иванова-Петрова MacArthur".split()
    initials = ["Q.", "X. Y.", "Q.X.", "X.-Q."]
    particles = ["van der", "Van Der", "von", "De la", "bin", ""]
    texts, used = [], []
    for _ in range(400):
        names = r.sample(parts, r.randrange(1, 4))
        words = [*r.choices(initials, k=r.randrange(2)), *names[:-1], *([p] if (p := r.choice(particles)) else []), names[-1]]
        title = r.choice(["Mr ", "Mrs. ", "Dr ", "Herr ", "Prof. Dr. ", "Господин "])
        texts.append(f"seen by {title}{' '.join(words)}{r.choice([' at nine', ', then', '’s car', chr(10) + 'The End', '. So'])}")
        used.append(names)
    got = replaced(spark, texts)
    for k, names in enumerate(used):
        assert not any(n.lower() in got[k].lower() or any(len(h) > 3 and h.lower() in got[k].lower() for h in re.split("[-'’]", n)) for n in names), (texts[k], got[k])
        assert not re.search(r"\b[QX]\.|\b[Vv]an |De la|\bbin ", got[k]), (texts[k], got[k])
        tail = re.search(r"( at nine|, then|’s car|\nThe End|\. So)$", texts[k])[0]
        assert got[k].endswith(tail) and got[k].startswith(texts[k][:10])


def test_forms_of_names_and_coreference(spark):
    texts = ["Mr Van Der Berg met Mr Karl Van Der Berg", "Dr J. Weiss and Mr Weiss and Mr Weiss’s", "Mrs Smith-Jones", "Frau DUPONT", "Mr X", "Mr and Mrs", "Dr. who"]
    got = replaced(spark, texts)
    one, two = re.fullmatch(r"Mr (\w+) met Mr \w+ (\w+)", got[0]).groups()
    assert one == two
    a, b, c = re.fullmatch(r"Dr [A-Z]\.? ?(\w+) and Mr (\w+) and Mr (\w+)’s", got[1]).groups()
    assert a == b == c != "Weiss"
    assert re.fullmatch(r"Mrs [A-Z][a-z]+-[A-Z][a-z]+", got[2]) and got[2] != texts[2]
    assert got[3] != texts[3] and got[4] != texts[4] and (got[5], got[6]) == (texts[5], texts[6])


def test_secrets_of_any_length(spark):
    texts = ["key " + "a1" * n + " end" for n in (16, 64, 65, 500, 4000)]
    got = replaced(spark, texts)
    for k, t in enumerate(texts):
        assert len(got[k]) == len(t) and got[k] != t and got[k].startswith("key ") and got[k].endswith(" end")
    assert replaced(spark, ["a" * 40, "word" * 10000]) == {0: "a" * 40, 1: "word" * 10000}
