"""Queries over texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.plans.base import query
from tessera.sources.tables import table


@query("""
SELECT lang, source, chars, doc_id FROM (
  SELECT lang, source, CAST(length(text) AS BIGINT) AS chars, doc_id,
         row_number() OVER (PARTITION BY lang, source ORDER BY length(text) DESC, doc_id) AS rn
  FROM documents) WHERE rn = 1""")
def richest_per_key(spark, sf_dir):
    """Longest document of each (lang, source); the smallest doc_id of equally long ones."""
    best = F.max(F.struct(F.length("text").cast("long").alias("chars"), (-F.col("doc_id")).alias("neg")))
    out = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(best.alias("m"))
    return out.select("lang", "source", F.col("m.chars").alias("chars"), (-F.col("m.neg")).alias("doc_id"))


@query("SELECT md5(text) AS key, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_keys_having(spark, sf_dir):
    """Keys that occur more than once."""
    rows = table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("key"))
    return rows.agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


@query("""
SELECT doc_id, try_cast(nullif(regexp_extract(text, '(\\d+\\.\\d+)', 1), '') AS DOUBLE) AS number,
  CAST(len(regexp_extract_all(text, '[A-Z][a-z]+')) AS BIGINT) AS capitals FROM documents""")
def regex_extract_num(spark, sf_dir):
    """First decimal number of a text and its count of capitalised words."""
    first = F.nullif(F.regexp_extract("text", r"(\d+\.\d+)", 1), F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "doc_id", first.try_cast("double").alias("number"), F.size(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))).cast("long").alias("capitals")
    )


@query("""
SELECT CASE WHEN length(text) < 50 THEN 'short' WHEN regexp_matches(text, '(?i)licen[cs]e') THEN 'license' WHEN regexp_matches(text, '\\d{9,}') THEN 'numbers'
  WHEN text ILIKE '%token%' THEN 'secret' ELSE 'prose' END AS kind, count(*) AS n FROM documents GROUP BY 1""")
def keyword_triage(spark, sf_dir):
    """Texts sorted by length, pattern and keyword; the first rule that holds."""
    t = F.col("text")
    rules = [("short", F.length(t) < 50), ("license", t.rlike("(?i)licen[cs]e")), ("numbers", t.rlike(r"\d{9,}")), ("secret", t.ilike("%token%"))]
    return table(spark, sf_dir, "documents").groupBy(text.first_rule(rules, "prose").alias("kind")).agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, CASE WHEN text ILIKE '%idiot%' OR text ILIKE '%worthless%' THEN 'major' WHEN text ILIKE '%!!%' THEN 'moderate'
  WHEN text ILIKE '%|%' AND NOT text ILIKE '%license%' THEN 'minor' ELSE 'unknown' END AS severity FROM documents""")
def severity_case_order(spark, sf_dir):
    """A classification by ordered keyword rules."""
    t = F.col("text")
    rules = [("major", t.ilike("%idiot%") | t.ilike("%worthless%")), ("moderate", t.ilike("%!!%")), ("minor", t.ilike("%|%") & ~t.ilike("%license%"))]
    return table(spark, sf_dir, "documents").select("doc_id", text.first_rule(rules, "unknown").alias("severity"))


_CHUNK = 2000


@query(f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
c AS (
  SELECT r, doc_id, text, 0 AS chunk, CAST(0 AS BIGINT) AS pos, CAST(NULL AS VARCHAR) AS piece FROM d
  UNION ALL
  SELECT r, doc_id, text, chunk + 1, pos + length(p), p FROM (
    SELECT *, CASE WHEN pos + {_CHUNK} < length(text) AND strpos(reverse(w), chr(10)) BETWEEN 1 AND length(w) - 1
                   THEN left(w, length(w) - strpos(reverse(w), chr(10)) + 1) ELSE w END AS p
    FROM (SELECT *, substr(text, pos + 1, {_CHUNK}) AS w FROM c WHERE pos < length(text))))
SELECT doc_id, chunk - 1 AS chunk, length(piece) AS n_chars, md5(piece) AS key FROM c WHERE chunk > 0""")
def chunk_text(spark, sf_dir):
    """Texts in chunks of 2,000 characters at most: doc_id, chunk, n_chars, key."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"), _CHUNK)).alias("chunk", "piece"))
    return rows.select("doc_id", "chunk", F.length("piece").cast("long").alias("n_chars"), F.md5("piece").alias("key"))
