"""Row numbers and equal batches of whole tables, without one sorted task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import stage


def numbered(df: DataFrame, order: list[Column | str], name: str = "n") -> DataFrame:
    """`df` with the number of each row (from 0) in `order`, in a column `name`.

    Rows are dealt by range and sorted within their ranges; the counts of the ranges, one number each, give every range
    its first number. `order` has to be total for the numbers to be fixed.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the range in its upper bits and the place within the range below.
    rows = stage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).collect()
    first, starts = 0, []
    for r in sorted(counts, key=lambda r: r["_part"]):
        starts.append((r["_part"], first))
        first += r["_rows"]
    known = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _first long"))
    number = F.col("_first") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("_part", part).join(known, "_part").withColumn(name, number).drop("_part", "_first", "_at")


def numbered_within(df: DataFrame, group: list[str], order: list[str], name: str = "n") -> DataFrame:
    """The number of each row (from 0) within its group, which may hold any share of the rows."""
    rows = stage(numbered(df, [*group, *order], "_all"))
    first = rows.groupBy(*group).agg(F.min("_all").alias("_least"))
    same = [F.col(f"x.{g}").eqNullSafe(F.col(f"y.{g}")) for g in group]
    joined = rows.alias("x").join(first.alias("y"), same)
    return joined.select("x.*", (F.col("_all") - F.col("_least")).alias(name)).drop("_all")


def equal_batches(df: DataFrame, order: list[str], batches: int, name: str = "batch") -> DataFrame:
    """`df` with its batch, from 1: `batches` runs of consecutive rows whose sizes differ by one at most, longer ones first."""
    rows = stage(numbered(df, order, "_n"))
    total = rows.count()
    size, longer = divmod(total, batches)
    edge = longer * (size + 1)
    n = F.col("_n")
    batch = F.when(n < edge, F.floor(n / (size + 1))).otherwise(longer + F.floor((n - edge) / max(size, 1)))
    return rows.withColumn(name, (batch + 1).cast("int")).drop("_n")
