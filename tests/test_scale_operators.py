"""Selection, hubs, nearest vectors, layout and dead letters."""

import itertools
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import graph, quantile, vectors
from tessera.sources import layout, quarantine


@pytest.mark.parametrize("few, accuracy", [(10_000, 10_000), (5, 50)])
def test_quantile_equals_the_sorted_one(spark, few, accuracy):
    r = random.Random(few)
    for values in ([3.5], [1, 2], [7] * 900 + [8] * 101, [r.gauss(0, 1e6) for _ in range(2001)], [r.choice([1, 1, 1, 5, r.random()]) for _ in range(1500)], [None, 4, None, 9]):
        df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(4)
        known = sorted(v for v in values if v is not None)
        assert quantile.quantile(df, "v", 0.5, few, accuracy) == pytest.approx(statistics.median(known), rel=1e-12)
        at = 0.9 * (len(known) - 1)
        k = int(at)
        want = known[k] + (known[min(k + 1, len(known) - 1)] - known[k]) * (at - k)
        assert quantile.quantile(df, "v", 0.9, few, accuracy) == pytest.approx(want, rel=1e-12)
    assert quantile.quantile(df.limit(0), "v") is None


def test_quantile_of_many_rows(spark):
    df = spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_001).alias("v"))
    want = sorted(i * 7919 % 3_000_001 for i in range(3_000_000))
    assert quantile.quantile(df, "v") == (want[1_499_999] + want[1_500_000]) / 2


@pytest.mark.parametrize("ways", [3, 50, 1 << 20])
def test_two_hops_over_hubs(spark, ways):
    r = random.Random(ways)
    rows = {(s, r.choice([0, 0, 0, *range(1, 9)]), k) for s in range(60) for k in ("x", "y") for _ in range(3)}
    edges = spark.createDataFrame([*rows, *list(rows)[:20]], "src long, dst long, type string")
    by = {}
    for s, d, k in rows:
        by.setdefault((k, d), []).append(s)
    want = {}
    for d in range(9):
        for a, b in itertools.product(by.get(("x", d), []), by.get(("y", d), [])):
            if a != b:
                want[a, b] = want.get((a, b), 0) + 1
    assert {(p.a, p.b): p.paths for p in graph.two_hop(edges, "x", "y", ways).collect()} == want
    share = [{(a, b) for (kind, _), s in by.items() if kind == k for a, b in itertools.permutations(s, 2)} for k in "xy"]
    assert {tuple(p) for p in graph.alternatives(edges, "x", "y", ways).collect()} == share[0] & share[1]


def test_paths_of_equal_sources_are_counted_once(spark):
    rows = [(s, d, k) for s in range(60) for k, ds in (("x", [s % 3, 3]), ("y", [s % 2, 2 + s % 2])) for d in ds]
    edges = spark.createDataFrame(rows, "src long, dst long, type string")
    want = {}
    for (a, d, k), (b, f, m) in itertools.product(rows, rows):
        if d == f and (k, m) == ("x", "y") and a != b:
            want[a, b] = want.get((a, b), 0) + 1
    out = graph.two_hop(edges, "x", "y", 50)
    assert {(p.a, p.b): p.paths for p in out.collect()} == want and len(want) == out.count()
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_hub_is_dealt_to_many_tasks(spark):
    edges = spark.range(3000).select(F.col("id").alias("src"), F.lit(1).cast("long").alias("dst"), F.lit("x").alias("type"))
    x, y = graph._of(edges, "x", "a"), graph._of(edges, "x", "b")
    met = graph._meetings(x, y, ways=3000 * 3000 // 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 9_000_000 and max(sizes) < 4_000_000 and len(sizes) >= 6


def test_nearest_vectors(spark, monkeypatch):
    r = np.random.default_rng(3)
    n = 300
    x = np.round(r.normal(size=(n, 6)), 1)
    x[5], x[77:80] = 0, x[50]
    groups = [str(i % 3) if i % 11 else None for i in range(n)]
    rows = spark.createDataFrame([(i, groups[i], None if i == 9 else x[i].tolist()) for i in range(n)], "vec_id long, grp string, vector array<double>").repartition(5)
    queries = rows.filter("vec_id % 7 = 0").withColumnRenamed("vec_id", "query_id")
    want = {}
    for q in range(0, n, 7):
        scored = []
        for v in range(n):
            if v != q and groups[q] is not None and groups[v] == groups[q] and 5 not in (v, q) and 9 not in (v, q):
                scored.append((-round(float(x[q] @ x[v]) / float(np.sqrt((x[q] ** 2).sum() * (x[v] ** 2).sum())), 9), v))
        if scored:
            want[q] = [v for _, v in sorted(scored)[:4]]
    for size in (vectors.BLOCK_BYTES, 200):
        monkeypatch.setattr(vectors, "BLOCK_BYTES", size)
        got = {}
        for p in sorted(vectors.nearest(rows, queries, 4).collect(), key=lambda p: (p.query_id, -p.similarity, p.vec_id)):
            got.setdefault(p.query_id, []).append(p.vec_id)
        assert got == want
    plan = vectors.nearest(rows, queries, 4)._jdf.queryExecution().executedPlan().toString()
    assert "vector" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert vectors.nearest(rows, queries.limit(0), 4).count() == 0


def test_layout_by_source_is_pruned(spark, tmp_path):
    df = spark.range(400).select(F.col("id"), F.concat(F.lit("s"), F.col("id") % 20).alias("source"), F.lit("x").alias("text"))
    layout.write_by(df, f"{tmp_path}/t", "source", files=2)
    wanted = spark.createDataFrame([("s3",), ("s7",), ("s3",)], "source string")
    got = layout.of_sources(spark, f"{tmp_path}/t", "source", wanted)
    assert sorted(r.id for r in got.collect()) == [i for i in range(400) if i % 20 in (3, 7)]
    assert "dynamicpruning" in got._jdf.queryExecution().optimizedPlan().toString()
    scans = [s for s in got._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in s]
    assert scans and "dynamicpruningexpression" in scans[0]
    static = spark.read.parquet(f"{tmp_path}/t").filter("source = 's3'")
    assert {f.split("source=")[1].split("/")[0] for f in static.inputFiles()} >= {"s3"} and static.count() == 20


def test_dead_letters_and_counters(spark, tmp_path):
    (tmp_path / "a.rrf").write_text("1|x|y|\n2|z\n3||w|more|\n\n")
    out = quarantine.delimited(spark, f"{tmp_path}/a.rrf", ["id", "a", "b"])
    assert sorted(map(tuple, out.good.collect())) == [("1", "x", "y"), ("3", None, "w")]
    assert sorted((r.line, r.reason) for r in out.dead.collect()) == [("", "fewer than 3 fields: 1"), ("2|z", "fewer than 3 fields: 2")]
    assert out.counts == {"lines": 4, "dead": 2, "good": 2} and all("a.rrf" in r.file for r in out.dead.collect())
    (tmp_path / "b.jsonl").write_text('{"k": "a", "t": 1}\n{"k": "a", "t": 3}\nnot json\n{"k": null, "t": 2}\n{"k": "b", "t": "x"}\n[1]\n \n{"k": "b", "t": 2}\n')
    out = quarantine.latest_json(spark, f"{tmp_path}/b.jsonl", "k string, t long", "k", "t")
    assert sorted(map(tuple, out.good.collect())) == [("a", 3), ("b", 2)]
    assert sorted(r.reason for r in out.dead.collect()) == ["no JSON", "no k", "not of the schema", "not of the schema"]
    assert out.counts["dead"] + out.counts["good"] == out.counts["lines"] == 7
    (tmp_path / "c.tsv").write_text("name\tstatus\tv\na\tdone\t1\nb\topen\t2\n\tdone\t3\nd\tdone\n")
    out = quarantine.csv_table(spark, f"{tmp_path}/c.tsv", ["name"], status=("status", ("done",)))
    assert list(map(tuple, out.good.collect())) == [("a", "done", "1")]
    assert sorted(r.reason for r in out.dead.collect()) == ["blank name", "status", "wrong number of fields"]
    quarantine.append_dead(out.dead, f"{tmp_path}/dead", "r1")
    quarantine.append_dead(out.dead, f"{tmp_path}/dead", "r1")
    assert spark.read.parquet(f"{tmp_path}/dead").count() == 3
