"""Targets send their sources once to each home, and pairs of one kind of edge are counted once."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph

from .test_products_of_blocks import shuffled


def edges_of(seed, sources):
    r = random.Random(seed)
    rows = {(s, r.choice([r.randint(0, 40), s // 7]), k) for s in sources for k in ("x", "y") for _ in range(30 if s == sources[7] else 4)}
    rows |= {(s, 99, "x") for s in sources[:45]}
    return [*sorted(rows), *((s, None, "x") for s in sources[:9]), (None, 99, "x"), (None, 3, "y")]


def ways_of(rows, first, second):
    want = {}
    for (a, d, k), (b, f, m) in itertools.product(rows, rows):
        if None not in (a, b, d) and d == f and (k, m) == (first, second) and a != b:
            want[a, b] = want.get((a, b), 0) + 1
    return want


@pytest.mark.parametrize(
    "few, busy, ways, kind, of",
    [
        (1 << 25, 16, 1 << 20, "long", int),
        (0, 16, 1 << 20, "long", int),
        (0, 1, 40, "long", int),
        (0, 0, 1 << 20, "long", int),
        (0, 16, 300, "long", int),
        (0, 16, 1 << 20, "long", lambda s: s * 10**15 - 10**16),
        (0, 16, 1 << 20, "string", lambda s: f"s{s}"),
    ],
)
def test_pairs_by_homes(spark, monkeypatch, few, busy, ways, kind, of):
    monkeypatch.setattr(graph, "FEW_WAYS", few)
    monkeypatch.setattr(graph, "BUSY", busy)
    rows = [(None if s is None else of(s), d, k) for s, d, k in edges_of(ways, range(50))]
    edges = spark.createDataFrame(rows, f"src {kind}, dst long, type string")
    for first, second in (("x", "x"), ("x", "y")):
        got = graph.two_hop(edges, first, second, ways)
        assert [c for _, c in got.dtypes] == [edges.dtypes[0][1]] * 2 + ["bigint"]
        got, want = got.collect(), ways_of(rows, first, second)
        assert {(p.a, p.b): p.paths for p in got} == want and len(got) == len(want)
    want = set(ways_of(rows, "x", "x")) & set(ways_of(rows, "y", "y"))
    got = graph.alternatives(edges, "x", "y", ways).collect()
    assert {tuple(p) for p in got} == want and len(got) == len(want)


def test_lists_are_sent_once_to_a_home(spark, monkeypatch):
    monkeypatch.setattr(graph, "FEW_WAYS", 0, raising=False)
    r = random.Random(3)
    rows = [(s, 60 * c + t, "x") for c in range(20) for t in range(60) for s in r.sample(range(60 * c, 60 * c + 60), 40)]
    edges = spark.createDataFrame(rows, "src long, dst long, type string").withColumn("src", F.xxhash64("src"))
    before = shuffled(spark, "shuffleWriteBytes")
    assert graph.two_hop(edges, "x", "x").agg(F.count("*"), F.sum("paths")).first() == (20 * 60 * 59, 20 * 60 * 40 * 39)
    assert shuffled(spark, "shuffleWriteBytes") - before < 1_500_000


def test_homes_have_their_share_of_pairs(spark):
    r = random.Random(5)
    rows = [(s, t) for t in range(300) for s in r.sample(range(400), 24)]
    homes = spark.range(400).select(F.col("id").alias("a"), (F.col("id") % 9).cast("int").alias("home"))
    parcels = graph._parcels(spark.createDataFrame(rows, "a long, dst long"), None, homes).collect()
    met = {}
    for p in parcels:
        for a, b in [*itertools.combinations(p["as"], 2), *itertools.product(p["as"], p["bs"])]:
            met.setdefault(p["home"], []).append((min(a, b), max(a, b)))
    sizes = [len(v) for v in met.values()]
    assert sum(sizes) == 300 * 24 * 23 // 2 and len(sizes) == 9 and max(sizes) < 1.3 * min(sizes)
    assert sum(len(set(v)) for v in met.values()) == len({x for v in met.values() for x in v})


def test_sources_without_keys(spark, monkeypatch):
    monkeypatch.setattr(graph, "FEW_WAYS", 0)
    edges = spark.createDataFrame([(None, 1, k) for k in "xxyy"], "src long, dst long, type string").withColumn("dst", F.explode(F.expr("sequence(1L, 9L)")))
    x = graph._of(edges, "x", "a")
    assert graph._pairs([(x, None, 1)], F.sum, 1 << 20).collect() == []
