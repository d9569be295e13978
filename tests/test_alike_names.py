"""Fuzzy joins of names made of few words: all pairs are compared in blocks, with the results of the gram join."""

import itertools

import pytest

from tessera.operators import fuzzy
from tests.test_fuzzy_and_records import frame, partial, ratio

WORDS = (("hot", "old", "cold"), ("ring", "rod", "gear"), ("large", "small"), ("brand#1", "brand#12", "brand#2"))
TITLES = [" ".join(w) for w in itertools.product(*WORDS)]
NAMES = [t[:4] + t[5:] for t in TITLES[::3]] + [f"{t} extended release" for t in TITLES[::4]] + ["qqqq", "g", "ri", "gear"]


def joins(spark):
    near = fuzzy.ratio_join(frame(spark, NAMES), frame(spark, TITLES), "x", "x", 85)
    return near, fuzzy.partial_join(frame(spark, NAMES), frame(spark, TITLES), "x", "x", 90)


@pytest.mark.parametrize("cost, blocks", [(0, 1000), (10**9, 1000), (10**9, 3)])
def test_alike_names_lose_no_pair(spark, monkeypatch, cost, blocks):
    monkeypatch.setattr(fuzzy, "PAIRS_A_ROW", cost)
    monkeypatch.setattr(fuzzy, "BLOCKS", blocks)
    near, part = ([tuple(r) for r in df.collect()] for df in joins(spark))
    assert len(near) == len(set(near)) and len(part) == len(set(part))
    assert set(near) == {(x, y, ratio(x, y)) for x in NAMES for y in TITLES if ratio(x, y) >= 85}
    assert set(part) == {(x, y, partial(x, y)) for x in NAMES for y in TITLES if len(x) >= 3 and partial(x, y) >= 90}


def test_alike_names_are_not_expanded_by_grams(spark):
    for df in joins(spark):
        assert "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()
