"""Resolution against plain programs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import batches, passjoin, resolve, resolver


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, old = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (c != d)))
    return row[-1]


@pytest.mark.parametrize("percent", [60, 75, 90, 34])
def test_ratio_join_loses_no_pair(spark, percent):
    r = random.Random(percent)
    left = sorted({"".join(r.choices("abc", k=r.randrange(1, 14))) for _ in range(70)})
    right = sorted({"".join(r.choices("abc", k=r.randrange(1, 14))) for _ in range(70)} | {x[1:] + "a" for x in left[:20]} | {""})
    x, y = (spark.createDataFrame([(n,) for n in names], "x string") for names in (left, right))
    got = {(p.a, p.b) for p in passjoin.ratio_join(x, y, "x", "x", percent).collect()}
    assert got == {(a, b) for a in left for b in right if b and distance(a, b) <= max(len(a), len(b)) * (100 - percent) // 100}


def sequential(wants, turns):
    """The program: sources in order, each with its best free target."""
    gone, out = set(), {}
    for s in turns:
        for _, t, keeps in sorted(w for w in wants.get(s, ())):
            if t not in gone:
                out[s] = t
                if not keeps:
                    gone.add(t)
                break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_claims_equal_the_sequential_program(spark, seed):
    r = random.Random(seed)
    wants = {}
    for s in range(120):
        own = range(40) if s % 3 == 0 else r.sample(range(60), r.randrange(0, 9))
        wants[s] = [(t if s % 3 == 0 else r.randrange(5), t, r.random() < (0.2 if s % 5 == 0 else 0)) for t in own]
    rows = [(s, t, k, keeps) for s, ws in wants.items() for k, t, keeps in ws]
    df = spark.createDataFrame(rows, "s long, t long, k long, keeps boolean").repartition(3)
    got = {x.s: x.t for x in resolve.claims(df, "s", "t", [], ["k"], F.col("keeps")).collect()}
    assert got == sequential(wants, sorted(wants))


@pytest.mark.parametrize("seed", [0, 1, 3])
def test_updates_by_name_equal_the_sequential_program(spark, seed):
    r = random.Random(seed)
    names = ["ab", "abc", "abd", "b", "bc", "cab", None]
    sources = [(s, r.choice([*names[:6], "a", "AB", "zz", ""]), r.choice(["v", "w", None])) for s in range(40)]
    targets = [(t, r.choice(names), r.choice(["v", "x", None]) if seed % 2 else "x") for t in range(30)]
    # Seeds below 3: synonyms follow from names, so that targets form long queues; else they are mixed.
    synonyms = [(t, n and n[::-1]) for t, n, _ in targets] if seed < 3 else [(r.randrange(35), r.choice(names)) for _ in range(30)]
    wants, value = {}, {t: v for t, _, v in targets}
    for s, name, new in sources:
        for kind, known in ((1, [x[:2] for x in targets]), (3, synonyms)):
            for t, n in known:
                if name and n and n.startswith(name.lower()) and t in value:
                    wants.setdefault(s, {}).setdefault(t, []).append((kind + (n != name.lower()), n))
    order = {s: [((*min(w), t), t, new == value[t]) for t, w in wants.get(s, {}).items()] for s, _, new in sources}
    taken = sequential(order, range(40))
    steps = {(s, t): k[0] for s, ws in order.items() for k, t, _ in ws}
    x, y, z = (spark.createDataFrame(rows, f"{c}, name string{v}").repartition(3) for rows, c, v in (
        (sources, "source long", ", value string"), (targets, "target long", ", value string"), (synonyms, "target long", "")))
    got = {p.source: (p.target, p.step) for p in resolve.update_by_name(x, y, z).collect()}
    assert got == {s: (taken.get(s), steps.get((s, taken.get(s)))) for s in range(40)}


def test_names_begun_by_others(spark):
    heads, texts = ["a", "ab", "b", "abc", ""], ["abc", "ab", "a", "bcd", "x", None]
    x, y = (spark.createDataFrame([(n,) for n in names], f"{c} string") for names, c in ((heads, "h"), (texts, "t")))
    got = {(p.h, p.t) for p in resolve.begun(x.filter("h <> ''"), y, "h", "t").collect()}
    assert got == {(h, t) for h in heads for t in texts if h and t and t != h and t.startswith(h)}


def test_resolved_names_do_not_reach_dearer_tiers(spark):
    relations = resolver.Relations(
        spark.createDataFrame([("b", "Brand", 1), ("c", "Combo", None)], "brand_id string, brand string, id long"),
        spark.createDataFrame([("c", 7), ("c", 8), ("c", None)], "brand_id string, id long"),
        spark.createDataFrame([(3, "Metformin", ["Glu"], "METFORMIN"), (4, "Aspirin", [], "ASPIRIN")], "id long, name string, other_names array<string>, plain_name string"),
        spark.createDataFrame([("ASA", 4), ("ASA", 5), ("none", None)], "synonym string, id long"),
    )
    reached = {}

    def spy(tier):
        def find(names, r):
            reached[tier.label] = {x.name for x in names.select("name").collect()}
            return tier.find(names, r)

        return resolver.Tier(tier.label, find)

    names = ["brand", "COMBO", "glu", "metformin hydrochloride", "asa", "metformine", "zzz", None, "brand"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = sorted(tuple(x) for x in resolver.resolve(df, relations, tuple(map(spy, resolver.EIGHT))).collect())
    assert got == [
        ("COMBO", 2, "combination", 7, "Combo"), ("COMBO", 2, "combination", 8, "Combo"), ("asa", 5, "synonym", 4, "ASA"), ("asa", 5, "synonym", 5, "ASA"),
        ("brand", 1, "brand_exact", 1, "Brand"), ("glu", 3, "entity", 3, "Metformin"), ("metformin hydrochloride", 4, "plain_entity", 3, "Metformin"),
        ("metformine", 7, "fuzzy_entity", 3, "Metformin"),
    ]
    assert reached["fuzzy_brand"] == {"metformine", "zzz"} and "metformine" not in reached["fuzzy_synonym"]
    assert resolver.resolve(df.limit(0), relations).count() == 0


def test_equal_batches_and_numbers(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, 1, 1, 1, 2])) for i in range(1003)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, g long").repartition(7)
    assert sorted((x.n, x.id) for x in batches.numbered(df, ["id"]).collect()) == [(i, i) for i in range(1003)]
    for n in (1, 4, 10, 2000):
        out = batches.equal_batches(df, ["id"], n).collect()
        sizes = [0] * n
        for x in out:
            sizes[x.batch - 1] += 1
        assert max(sizes) - min(sizes) <= 1 and [x.batch for x in sorted(out)] == sorted(x.batch for x in out)
    within = {}
    for x in batches.numbered_within(df, ["g"], ["id"]).collect():
        within.setdefault(x.g, []).append((x.id, x.n))
    assert all([k for _, k in sorted(v)] == list(range(len(v))) for v in within.values()) and len(within) == 3
    assert batches.equal_batches(df.limit(0), ["id"], 3).count() == 0


def test_claims_grow_with_sources_plus_targets(spark):
    # 30,000 sources and 6,000 targets of one name: no row for each pair of them.
    sources = spark.range(30_000).select(F.col("id").alias("source"), F.lit("ab").alias("name"), (F.col("id") % 2).cast("string").alias("value"))
    targets = spark.range(6_000).select(F.col("id").alias("target"), F.lit("abc").alias("name"), (F.col("id") % 3).cast("string").alias("value"))
    out = resolve.update_by_name(sources, targets, targets.select("target", F.lit("cba").alias("name")))
    lists, queues = resolve.name_queues(sources, targets, targets.select("target", F.lit("cba").alias("name")))
    assert lists.count() == 1 and queues.count() == 6_000
    assert out.filter("action = 'changed'").count() == 6_000 and out.filter("action = 'inserted'").count() > 10_000
