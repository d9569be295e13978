"""The resolver as a table function over names that ask often and have many rows."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import resolver


@pytest.mark.parametrize("side", [2, 7, 1024])
def test_hot_names_lose_and_repeat_nothing(spark, side):
    asked = [(i, name) for i, name in enumerate(["a"] * 40 + ["b"] * 3 + ["c", "d", None, "e"] + ["f"] * 60)]
    found = [("a", 1, "t", i, "m") for i in range(30)] + [("b", 2, "t", 7, None), ("c", 2, None, 8, "x"), ("c", 2, None, 8, "x"), ("z", 1, "t", 1, "m")] + [("d", 1, "t", i, "m") for i in range(90)]
    out = resolver.look_up(spark.createDataFrame(asked, "k long, name string"), spark.createDataFrame(found, resolver.COLUMNS), side)
    want = [(k, name, *f[1:]) for k, name in asked for f in [f for f in found if f[0] == name] or [(None,) * 5]]
    assert out.columns == ["k", "name", "step", "match_type", "id", "matched"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_a_hot_name_is_dealt_to_many_tasks(spark):
    asked = spark.range(3000).select("id", F.lit("a").alias("name")).withColumnRenamed("id", "k")
    found = spark.range(3000).select(F.lit("a").alias("name"), F.lit(1).alias("step"), F.lit("t").alias("match_type"), "id", F.lit("m").alias("matched"))
    tasks = [r["n"] for r in resolver.look_up(asked, found, 300).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 9_000_000 and len(tasks) >= 20 and max(tasks) < 1_000_000
