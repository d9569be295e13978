"""Sinks: batches of JSON lines, audits, overwritten tables, graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_batches(df: DataFrame, path: str, key: str, batches: int) -> None:
    """JSON lines in `batches` folders of about equal size, by a hash of the key."""
    batch = F.pmod(F.xxhash64(key), F.lit(batches)).alias("batch")
    df.select(batch, F.to_json(F.struct(*df.columns)).alias("value")).repartition("batch").write.mode("overwrite").partitionBy("batch").text(path)


def append_audit(decisions: DataFrame, path: str, run_id: str, mode: str) -> None:
    """Appends decisions as one partition of an audit table; a run that is repeated replaces its own partition."""
    decisions.withColumn("mode", F.lit(mode)).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def has_dry_run(audit: DataFrame) -> bool:
    """Whether the audit holds a dry run, the precondition of a full run."""
    return not audit.filter("mode = 'dry_run'").isEmpty()


def graph_tables(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Node and edge tables; of several rows of a node (label, id) or edge (src, dst, type) the greatest props stay."""
    nodes.groupBy("label", "id").agg(F.max("props").alias("props")).write.mode("overwrite").partitionBy("label").parquet(f"{path}/nodes")
    edges.groupBy("src", "dst", "type").agg(F.max("props").alias("props")).write.mode("overwrite").partitionBy("type").parquet(f"{path}/edges")


def rebuild(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """A table built anew, bucketed and sorted by its keys so that joins on them need no shuffle.

    Rows are dealt by the keys first: one file for each bucket.
    """
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def report_csv(df: DataFrame, path: str) -> None:
    """A report as CSV files with a header; values with separators, quotes or line feeds are quoted."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def report_json(df: DataFrame, path: str) -> None:
    """Statistics as JSON lines; nulls are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def report_text(df: DataFrame, path: str, rule: str = "-" * 40) -> None:
    """Records in a form for reading: one line for each field, a rule behind each record."""
    fields = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in df.columns]
    df.select(F.concat_ws("\n", *fields, F.lit(rule)).alias("value")).write.mode("overwrite").text(path)
