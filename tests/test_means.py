"""Means against exact arithmetic."""

import random


def test_a_mean_at_the_limit_does_not_depend_on_the_order(spark, tmp_path):
    from fractions import Fraction

    from tessera.plans import lookups

    r = random.Random(4)
    cents = [r.randrange(11) for _ in range(572)]
    while sum(cents) != 5 * len(cents):
        cents[r.randrange(572)] += 1 if sum(cents) < 5 * len(cents) else -1
    orders = []
    for _ in range(3000):
        r.shuffle(cents)
        mean = 0.0
        for c in cents:
            mean += c / 100
        if (mean / len(cents) < 0.05) == (len(orders) % 2 == 0):
            orders.append([c / 100 for c in cents])
    orders = orders[:12]
    assert len(orders) == 12
    below = sum(map(Fraction, orders[0])) < Fraction(0.05) * len(cents)
    rows = [(s, d, 1.0 + s) for s, values in enumerate([*orders, [0.04], [0.06]]) for d in values]
    spark.createDataFrame(rows, "l_suppkey long, l_discount double, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(14).selectExpr("id AS s_suppkey", "0 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'x' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    got = [x.s_suppkey for x in sorted(lookups.ranked_candidates(spark, str(tmp_path)).collect(), key=lambda x: x.place)]
    assert got == ([*range(11, -1, -1), 12, 13] if below else [12, *range(11, -1, -1), 13])
