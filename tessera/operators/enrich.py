"""Filling gaps of records from their siblings: decisions first, then their application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.jsonx import is_blank
from tessera.operators.rank import first_of


def sibling_decisions(df: DataFrame, group: list[str], key: str, column: str, blank: Callable[[Column], Column] = is_blank) -> DataFrame:
    """For each row with a blank value: the longest value in its group (least key of equals), or that there is none.

    `blank` decides what a gap is (of JSON text by default). One row for each gap: key, filled_value, source_key, status ("filled" or "skipped").
    """
    gap = blank(F.col(column))
    donors = df.filter(~gap).select(*group, F.col(column).alias("filled_value"), F.col(key).alias("source_key"))
    best = first_of(donors, group, [F.length("filled_value").desc(), F.col("source_key")])
    return (
        df.filter(gap).select(key, *group).join(best, group, "left")
        .withColumn("status", F.when(F.col("source_key").isNull(), "skipped").otherwise("filled"))
        .select(key, "filled_value", "source_key", "status")
    )


def apply_decisions(df: DataFrame, decisions: DataFrame, key: str, column: str) -> DataFrame:
    """`df` with its gaps filled as decided."""
    fills = decisions.filter("status = 'filled'").select(key, "filled_value")
    return df.join(fills, key, "left").withColumn(column, F.coalesce("filled_value", column)).select(df.columns)


def union_distinct_values(df: DataFrame, group: list[str], key: str, column: str) -> DataFrame:
    """Values of each group without case-insensitive repeats, the first spelling (by key) kept, in order of key."""
    folded = F.lower(F.trim(F.col(column)))
    firsts = first_of(df.filter(F.col(column).isNotNull()).withColumn("_fold", folded), [*group, "_fold"], [F.col(key)])
    ordered = F.array_sort(F.collect_list(F.struct(key, column)))
    return firsts.groupBy(*group).agg(F.transform(ordered, lambda x: x[column]).alias("values"))
