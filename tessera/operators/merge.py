"""Write semantics as joins: what a sink would hold after inserts and updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`old` and those rows of `new` whose key it lacks. Keys of `new` must be distinct."""
    return old.unionByName(new.join(old, keys, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], nulls: bool = False) -> DataFrame:
    """`old` with rows of `new` inserted or replacing those of their key, column by column where not null; with `nulls`,
    nulls of the new row replace values too."""
    rest = [c for c in old.columns if c not in keys]
    joined = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), keys, "full")
    kept = [F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if nulls else F.coalesce(f"n.{c}", f"o.{c}") for c in rest]
    return joined.select(*keys, *[x.alias(c) for x, c in zip(kept, rest)])


def fill_nulls(old: DataFrame, new: DataFrame, keys: list[str], column: str) -> DataFrame:
    """`old` with nulls of `column` taken from `new`; other values are never overwritten."""
    fills = new.select(*keys, F.col(column).alias("_fill"))
    return old.join(fills, keys, "left").withColumn(column, F.coalesce(column, "_fill")).select(old.columns)


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose value is not among those of another column; nulls on the other side are left out of account."""
    values = other.select(F.col(other_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return df.filter(F.col(column).isNotNull()).join(values, column, "left_anti")


def diff_runs(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs between two runs, or that only one has: keys, value_before, value_after."""
    b = before.select(*keys, F.col(value).alias("value_before"))
    a = after.select(*keys, F.col(value).alias("value_after"))
    return b.join(a, keys, "full").filter(~F.col("value_before").eqNullSafe(F.col("value_after")))
