"""Ranking operators: every choice among rows has a total order."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key. `order` must end in a unique column for the result to be fixed."""
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")


def waterfall(candidates: DataFrame, key: str, tier: str, order: list[Column]) -> DataFrame:
    """The best candidate of each key: lowest tier first, then `order`. Tiers need no loop over unresolved rows."""
    return first_of(candidates, [key], [F.col(tier), *order])


def first_tier(candidates: DataFrame, key: str, tier: str, order: list[Column], limit: int | None = None) -> DataFrame:
    """All candidates of each key's first non-empty tier, at most `limit` in `order`."""
    best = F.min(tier).over(W.partitionBy(key))
    rows = candidates.withColumn("_best", best).filter(F.col(tier) == F.col("_best")).drop("_best")
    return rows if limit is None else first_of(rows, [key], order, limit)


def vote(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, the least of equally frequent ones, with its count as `votes`."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("votes"))
    best = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("votes")).alias("less"), F.col(value).alias("value"))).alias("best"))
    return best.select(*keys, (-F.col("best.less")).alias("votes"), F.col("best.value").alias(value))


def most_specific(rules: list[tuple[int, list[Column]]]) -> Column:
    """The rule with the most conditions of those that hold in full, the least of equals, as (less, rule), which sorts
    the better rule first; null without any.

    A short fixed list of rules is tried within the row, with neither a join nor a shuffle.
    """
    tried = [
        F.when(reduce(and_, conditions, F.lit(True)), F.struct(F.lit(-len(conditions)).alias("less"), F.lit(rule).alias("rule")))
        for rule, conditions in rules
    ]
    return F.array_min(F.array(*tried))
