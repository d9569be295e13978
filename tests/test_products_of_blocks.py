"""Sources of hubs and members of classes are sent in blocks, pairs are not."""

import itertools

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph


def shuffled(spark, what="shuffleWriteRecords"):
    """Rows (or bytes) that all stages so far have written to shuffles."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    sc.listenerBus().waitUntilEmpty()
    none = spark.sparkContext._gateway.new_array(jvm.double, 0)
    stages = sc.statusStore().stageList(None, False, False, none, jvm.java.util.ArrayList())
    return sum(getattr(stages.apply(k), what)() for k in range(stages.size()))


@pytest.mark.parametrize("classes", [1, 400])
def test_pairs_of_a_hub_are_not_shuffled(spark, classes):
    rows = spark.range(1200).select(F.col("id").alias("src"), F.explode(F.expr(f"array(0L, 1 + id % {classes})")).alias("dst"))
    edges = rows.filter("dst = 0").withColumn("type", F.lit("x")).unionByName(rows.withColumn("type", F.lit("y")))
    before = shuffled(spark)
    got = graph.two_hop(edges, "x", "y", ways=1000)
    assert got.groupBy("paths").count().collect() == [(1, 1200 * 1199)]
    assert shuffled(spark) - before < 100_000


@pytest.mark.parametrize("block", [1, 7, 512])
def test_every_member_meets_every_member(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK", block)
    left, right = ({p: range(10 * p, 10 * p + n) for p, n in sizes.items()} for sizes in ({1: 1, 2: 9, 3: 4}, {1: 8, 4: 3, 5: 7}))
    met = [(1, 1, 5), (2, 1, 6), (3, 4, 7), (2, 5, 8), (9, 1, 9), (1, 9, 9)]
    sides = [spark.createDataFrame([(k, p) for p, ks in members.items() for k in ks], names) for members, names in ((left, "a long, p long"), (right, "b long, q long"))]
    got = graph._products(spark.createDataFrame(met, "p long, q long, paths long"), *sides)
    want = [(a, b, n) for p, q, n in met for a, b in itertools.product(left.get(p, ()), right.get(q, ()))]
    assert sorted(map(tuple, got.select("a", "b", "paths").collect())) == sorted(want)
