"""Readers of other formats, as one declarative plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.rank import first_of


def delimited(spark: SparkSession, path: str, columns: list[str], delimiter: str = "|") -> DataFrame:
    """Lines of delimited fields without a header: lines with fewer fields are skipped, further fields ignored, empty
    fields null. Quotes have no meaning."""
    parts = F.split("value", f"\\Q{delimiter}\\E")
    rows = spark.read.text(path).select(parts.alias("p")).filter(F.size("p") >= len(columns))
    return rows.select(*[F.nullif(F.get("p", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


def table_with_header(spark: SparkSession, path: str, required: list[str], delimiter: str = ",") -> DataFrame:
    """Rows of a CSV or TSV file with a header, all columns as text, without rows in which a required column is blank."""
    rows = spark.read.option("header", True).option("sep", delimiter).csv(path)
    for c in required:
        rows = rows.filter(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) != "")
    return rows


def synonym_groups(spark: SparkSession, path: str) -> DataFrame:
    """Rows (group_id, place, synonym) of a JSON document {synonyms: [{id, synonyms: [...]}]}."""
    schema = "synonyms array<struct<id:string,synonyms:array<string>>>"
    groups = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("synonyms").alias("g"))
    return groups.select(F.col("g.id").alias("group_id"), F.posexplode("g.synonyms").alias("place", "synonym"))


def latest_lines(spark: SparkSession, path: str, schema: str, key: str, order: str) -> DataFrame:
    """JSON lines, malformed ones skipped, the latest of each key (equal ones: the greater line)."""
    rows = spark.read.text(path).select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    rows = rows.select("r.*", "value").filter(F.col(key).isNotNull())
    return first_of(rows, [key], [F.col(order).desc_nulls_last(), F.col("value").desc()]).drop("value")


def log_lines(spark: SparkSession, path: str, pattern: str, columns: list[str]) -> DataFrame:
    """The groups of a pattern in each line that it matches."""
    rows = spark.read.text(path).filter(F.col("value").rlike(pattern))
    return rows.select(*[F.regexp_extract("value", pattern, i + 1).alias(c) for i, c in enumerate(columns)])
