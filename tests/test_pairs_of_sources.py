"""Pairs of sources are counted where their first source is, with hubs and busy sources made apart."""

import itertools
import random
import re

import pytest

from tessera.operators import graph


def edges_of(seed):
    r = random.Random(seed)
    rows = {(s, r.randint(0, 40), k) for s in range(50) for k in ("x", "y") for _ in range(30 if s == 7 else 4)}
    return sorted(rows | {(s, 99, "x") for s in range(45)})


@pytest.mark.parametrize("busy, ways", [(16, 1 << 20), (1, 40), (0, 1 << 20), (16, 300)])
def test_pairs_of_busy_sources_and_hubs(spark, monkeypatch, busy, ways):
    monkeypatch.setattr(graph, "BUSY", busy)
    rows = edges_of(ways)
    edges = spark.createDataFrame(rows, "src long, dst long, type string")
    for first, second in (("x", "x"), ("x", "y")):
        want = {}
        for (a, d, k), (b, f, m) in itertools.product(rows, rows):
            if d == f and (k, m) == (first, second) and a != b:
                want[a, b] = want.get((a, b), 0) + 1
        got = graph.two_hop(edges, first, second, ways).collect()
        assert {(p.a, p.b): p.paths for p in got} == want and len(got) == len(want)
    share = [{(a, b) for (a, d, m), (b, f, n) in itertools.product(rows, rows) if m == n == k and d == f and a != b} for k in "xy"]
    got = graph.alternatives(edges, "x", "y", ways).collect()
    assert {tuple(p) for p in got} == share[0] & share[1] and len(got) == len(share[0] & share[1])


def test_ways_are_not_shuffled(spark):
    edges = spark.createDataFrame(edges_of(1), "src long, dst long, type string")
    plan = graph.two_hop(edges, "x", "x")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(a#\w+, \d+\)", plan) and not re.search(r"hashpartitioning\(a#\w+, b#", plan)
