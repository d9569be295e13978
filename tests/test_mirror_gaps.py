"""Edges without a reverse, in groups of rows."""

from tessera.operators import graph


def test_an_edge_meets_its_reverse_in_one_shuffle(spark):
    rows = [(1, 2), (2, 1), (1, 3), (3, 1), (3, 1), (4, 2), (4, 2), (5, 5), (2, 6), (None, 1), (1, None), (None, None), (7, 1), (0, 7)]
    out = graph.mirror_gaps(spark.createDataFrame(rows, "a long, b long"), 5)
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [(4, 2), (2, 6), (None, 1), (1, None), (None, None), (7, 1), (0, 7)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
