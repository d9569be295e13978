"""Similarity joins of names, by blocking that loses no match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import trigrams
from tessera.operators.rank import first_of
from tessera.session import stage


def trigram_join(left: DataFrame, right: DataFrame, a: str, b: str, at_least: float) -> DataFrame:
    """Pairs of values of trigram similarity (shared over all) of at least `at_least` (above 0): a, b, similarity.

    Values are distinct first. Trigrams are ordered by hash; of two values as similar as that, the first
    n - ceil(n * at_least) + 1 trigrams share one, so only those are joined, and sizes that cannot meet are left out.
    """

    def side(df: DataFrame, column: str, name: str) -> DataFrame:
        grams = F.array_sort(F.transform(trigrams(F.col(name)), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))
        rows = df.select(F.col(column).alias(name)).distinct().select(F.col(name), grams.alias("s"))
        n = F.size("s")
        rows = rows.filter(n > 0).select(name, n.alias(f"n{name}"), F.transform("s", lambda x: x["g"]).alias(f"g{name}"))
        n = F.col(f"n{name}")
        first = (n - F.ceil(n * at_least - 1e-9) + 1).cast("int")
        return rows.select("*", F.explode(F.slice(f"g{name}", F.lit(1), first)).alias("g"))

    fits = F.least("na", "nb") >= F.greatest("na", "nb") * at_least - 1e-9
    pairs = side(left, a, "a").join(side(right, b, "b"), "g").filter(fits).drop("g").dropDuplicates(["a", "b"])
    n = F.size(F.array_intersect("ga", "gb"))
    return pairs.select("a", "b", (n / (F.col("na") + F.col("nb") - n)).alias("similarity")).filter(F.col("similarity") >= at_least)


def most_similar(left: DataFrame, right: DataFrame, a: str, b: str, k: int, steps: tuple[float, ...] = (0.5, 0.25, 1e-9)) -> DataFrame:
    """The k most similar values of `b` of each value of `a`, itself left out: a, b, similarity; of equals the least b.

    Thresholds fall step by step: values with k partners at one are done, since all their other partners are less
    similar; only the rest goes to the next join, which makes more candidates.
    """
    open_values, known, out = stage(left.select(F.col(a).alias("a")).distinct()), stage(right.select(F.col(b).alias("b")).distinct()), None
    for step in steps:
        pairs = stage(trigram_join(open_values, known, "a", "b", step).filter("a <> b"))
        if step != steps[-1]:
            full = pairs.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") >= k).select("a")
            pairs, open_values = pairs.join(full, "a", "left_semi"), stage(open_values.join(full, "a", "left_anti"))
        best = first_of(pairs, ["a"], [F.col("similarity").desc(), F.col("b")], k)
        out = best if out is None else out.unionByName(best)
    return out
