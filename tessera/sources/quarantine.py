"""Readers that set bad lines aside: good rows, dead letters with reason and file, and counters from the same pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.session import stage


@dataclass(frozen=True)
class Sorted:
    """Rows that are whole, dead letters (file, line, reason), and how many of each there are."""

    good: DataFrame
    dead: DataFrame
    counts: dict[str, int]


def _sort_out(lines: DataFrame, reason: Column, fields: list[Column]) -> Sorted:
    """Lines (value, file) with a reason, or null for good ones; read and parsed once."""
    marked = lines.withColumn("reason", reason)
    seen = Observation()
    marked = marked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("dead"))
    rows = stage(marked)
    counts = dict(seen.get)
    counts["good"] = counts["lines"] - counts["dead"]
    dead = rows.filter("reason IS NOT NULL").select("file", F.col("value").alias("line"), "reason")
    return Sorted(rows.filter("reason IS NULL").select(*fields), dead, counts)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def delimited(spark: SparkSession, path: str, columns: list[str], delimiter: str = "|") -> Sorted:
    """Lines of delimited fields; those with too few fields are dead letters. Further fields are ignored, empty ones null."""
    lines = _lines(spark, path).withColumn("p", F.split("value", f"\\Q{delimiter}\\E"))
    reason = F.when(F.size("p") < len(columns), F.concat(F.lit(f"fewer than {len(columns)} fields: "), F.size("p").cast("string")))
    return _sort_out(lines, reason, [F.nullif(F.get("p", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


def json_lines(spark: SparkSession, path: str, schema: str, required: list[str]) -> Sorted:
    """JSON lines; text that is no object of the schema, or lacks a required field, is a dead letter. Blank lines are not."""
    lines = _lines(spark, path).filter(F.trim("value") != "")
    parsed = lines.withColumn("r", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    reason = F.when(F.try_parse_json("value").isNull(), "no JSON").when(F.col("r._corrupt").isNotNull() | F.col("r").isNull(), "not of the schema")
    for c in required:
        reason = reason.when(F.col(f"r.`{c}`").isNull(), f"no {c}")
    names = [x for x in spark.createDataFrame([], schema).columns]
    return _sort_out(parsed, reason, [F.col(f"r.`{c}`").alias(c) for c in names])


def delimiter_of(spark: SparkSession, path: str, candidates: str = ",\t;|") -> str:
    """The candidate that occurs most often in the first line of a file (the first candidate of equals)."""
    head = spark.read.text(path).first()
    return max(candidates, key=lambda c: (head[0].count(c) if head else 0, -candidates.index(c)))


def csv_table(spark: SparkSession, path: str, required: list[str], delimiter: str | None = None, status: tuple[str, tuple[str, ...]] | None = None) -> Sorted:
    """Rows of delimited files with a header, all columns as text; the delimiter is found in the header if not given.

    Rows of a wrong number of fields, or with a blank in a required column, are dead letters; so are those whose status
    column has none of the given values.
    """
    sep = delimiter or delimiter_of(spark, path)
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    schema = ", ".join(f"`{c}` string" for c in [*names, "_corrupt"])
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("columnNameOfCorruptRecord", "_corrupt")
    rows = reader.csv(path).withColumn("file", F.col("_metadata.file_path"))
    rows = rows.withColumn("value", F.coalesce("_corrupt", F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names])))
    reason = F.when(F.col("_corrupt").isNotNull(), "wrong number of fields")
    for c in required:
        reason = reason.when(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) == "", f"blank {c}")
    if status:
        reason = reason.when(~F.coalesce(F.col(f"`{status[0]}`").isin(*status[1]), F.lit(False)), "status")
    return _sort_out(rows, reason, [F.col(f"`{c}`") for c in names])


def latest_json(spark: SparkSession, path: str, schema: str, key: str, order: str) -> Sorted:
    """json_lines with the latest row of each key (of equal ones, the greater row)."""
    out = json_lines(spark, path, schema, [key])
    whole = F.struct(F.col(order), F.to_json(F.struct("*")).alias("text"))
    best = out.good.withColumn("_at", whole).groupBy(key).agg(F.max_by(F.struct(*out.good.columns), "_at").alias("r"))
    return Sorted(best.select("r.*"), out.dead, out.counts)


def append_dead(dead: DataFrame, path: str, run_id: str) -> None:
    """Appends dead letters as one partition; a run that is repeated replaces its own."""
    dead.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
