"""Tables laid out by source, so that a scan reads the sources it is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import stage


def write_by(df: DataFrame, path: str, column: str, files: int = 1) -> None:
    """A Parquet table with one folder for each value of `column`, and `files` files in each (a large source is split)."""
    split = F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c, t in df.dtypes if t != "variant"]), F.lit(files))
    df.repartition(F.col(column), split).write.mode("overwrite").partitionBy(column).parquet(path)


#: Names of sources that are broadcast at most; with more, the join shuffles and nothing is pruned at run time.
FEW_SOURCES = 100_000


def of_sources(spark: SparkSession, path: str, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of the sources that `wanted` names in a column of the same name; null and empty names have no folder.

    Where the names are few, they are broadcast, and the scan lists only their folders (dynamic partition pruning, for
    which the comparison with the empty name stands as the selective predicate that it asks for).
    """
    names = stage(wanted.select(F.col(column).cast("string").alias(column)).distinct()).filter(F.col(column) > "")
    few = names.count() <= FEW_SOURCES
    return spark.read.parquet(path).join(F.broadcast(names) if few else names, column, "left_semi")
