"""Semi-structured values: JSON paths, nested rows, arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import jsonx
from tessera.operators import rank, trees
from tessera.plans.base import query
from tessera.sources.tables import table


@query("""
SELECT CAST(props->>'$.k' AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def json_path_project(spark, sf_dir):
    """A typed field of a JSON column, parsed once."""
    rows = table(spark, sf_dir, "events").select(F.from_json("props", "k bigint")["k"].alias("k"), "value")
    return rows.groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def json_keys_count(spark, sf_dir):
    """Counts of the keys of JSON objects."""
    keys = table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


@query("""
SELECT event_type, count(*) FILTER (WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')) AS whole, count(*) FILTER (WHERE list_contains(json_keys(props), 'k')) AS has_k,
  count(*) FILTER (WHERE list_contains(json_keys(props), 'z')) AS has_z FROM events GROUP BY event_type""")
def json_type_guard(spark, sf_dir):
    """Type guards and key tests (a key with a null value is there)."""
    whole = F.schema_of_variant(F.variant_get(F.try_parse_json("props"), "$.k", "variant")) == "BIGINT"
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_if(whole).alias("whole"),
        F.count_if(jsonx.has_key(F.col("props"), "k")).alias("has_k"),
        F.count_if(jsonx.has_key(F.col("props"), "z")).alias("has_z"),
    )


@query("SELECT 'k' AS path, count(*) AS n, count(DISTINCT props->>'$.k') AS values FROM events WHERE list_contains(json_keys(props), 'k')")
def schema_paths(spark, sf_dir):
    """Catalogue of the paths of a JSON column, with counts of rows and of values."""
    paths = trees.catalogue(table(spark, sf_dir, "events"), "event_id", "props")
    return paths.select(F.array_join("path", ".", "[]").alias("path"), "n", "values")


@query("""
WITH b AS (SELECT user_id, event_id, event_type, CASE WHEN event_type <> 'error' THEN props END AS props FROM events),
d AS (SELECT user_id, event_type, props, event_id, row_number() OVER (PARTITION BY user_id ORDER BY length(props) DESC, event_id) AS r FROM b WHERE props IS NOT NULL)
SELECT b.event_id, d.props AS filled_value, d.event_id AS source_key, CASE WHEN d.event_id IS NULL THEN 'skipped' ELSE 'filled' END AS status
FROM b LEFT JOIN d ON d.user_id = b.user_id AND r = 1 WHERE b.props IS NULL""")
def sibling_json_fill(spark, sf_dir):
    """Blank JSON documents filled by the longest among those of the same user."""
    from tessera.operators.enrich import sibling_decisions

    rows = table(spark, sf_dir, "events").withColumn("props", F.when(F.col("event_type") != "error", F.col("props")))
    return sibling_decisions(rows, ["user_id"], "event_id", "props")


@query("""
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM documents) WHERE token <> '' GROUP BY token""")
def explode_tokens(spark, sf_dir):
    """Counts of tokens; repeats within a document are counted before the shuffle."""
    tokens = F.array_remove(F.split(F.lower("text"), "[^a-z]+"), "")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(tokens).alias("token"))
    per = rows.groupBy("token", "doc_id").agg(F.count("*").alias("c"))
    return per.groupBy("token").agg(F.sum("c").alias("n"), F.count("*").alias("docs"))


@query("""
SELECT role, length(s) AS chars, count(*) AS n FROM (SELECT role, unnest(string_split(line, '. ')) AS s FROM (
  SELECT role, unnest(string_split(text, chr(10))) AS line FROM conversations)) GROUP BY ALL""")
def lateral_two_level(spark, sf_dir):
    """Two levels of unnesting: lines of turns, sentences of lines."""
    lines = table(spark, sf_dir, "conversations").select("role", F.explode(F.split("text", "\n")).alias("line"))
    sentences = lines.select("role", F.explode(F.split("line", r"\. ")).alias("s"))
    return sentences.groupBy("role", F.length("s").cast("long").alias("chars")).agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT DISTINCT p_name, unnest(string_split(p_name, ' ')) AS token FROM part)
SELECT a.token, count(*) AS parts, count(DISTINCT t.p_name) AS names FROM part a2 JOIN t ON t.p_name = a2.p_name
JOIN (SELECT DISTINCT token FROM t) a ON a.token = t.token GROUP BY a.token""")
def array_contains_join(spark, sf_dir):
    """Join on membership in an array, as explode and equi-join over distinct keys."""
    parts = table(spark, sf_dir, "part").groupBy("p_name").agg(F.count("*").alias("c"))
    tokens = parts.select("p_name", "c", F.explode(F.array_distinct(F.split("p_name", " "))).alias("token"))
    return tokens.groupBy("token").agg(F.sum("c").alias("parts"), F.count("*").alias("names"))


@query("""
SELECT array_to_string(types, ',') AS types, count(*) AS users FROM (
  SELECT user_id, list_sort(list(DISTINCT event_type))[1:3] AS types FROM events GROUP BY user_id) GROUP BY types""")
def array_group_slice(spark, sf_dir):
    """Grouping by the first three of a sorted array."""
    per = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("t"))
    types = F.array_join(F.slice("t", 1, 3), ",")
    return per.groupBy(types.alias("types")).agg(F.count("*").alias("users"))


@query("""
WITH u AS (SELECT conv_id, turn, regexp_extract(text, '^(\\S+)', 1) AS key FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn, length(text) AS chars FROM conversations WHERE role = 'assistant')
SELECT lower(key) AS key, count(*) AS pairs, CAST(sum(chars) AS BIGINT) AS chars FROM u JOIN a USING (conv_id, turn) GROUP BY 1""")
def log_pair_recovery(spark, sf_dir):
    """Requests joined to their responses, keyed by a part parsed from the request."""
    turns = table(spark, sf_dir, "conversations")
    asks = turns.filter("role = 'user'").select("conv_id", "turn", F.lower(F.regexp_extract("text", r"^(\S+)", 1)).alias("key"))
    answers = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.length("text").cast("long").alias("chars"))
    return asks.join(answers, ["conv_id", "turn"]).groupBy("key").agg(F.count("*").alias("pairs"), F.sum("chars").alias("chars"))


@query("""
SELECT page_id, nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang,
  regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages""")
def html_text_clean(spark, sf_dir):
    """Title, language and host of web pages."""
    title = F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.nullif(title, F.lit("")).alias("title"),
        F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_extract("url", "^https?://([^/:?#]+)", 1).alias("host"),
    )


@query("""
SELECT event_type, count(*) AS n, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour FROM events GROUP BY ALL""")
def tumbling_counts(spark, sf_dir):
    """Counts in hourly windows."""
    rows = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return rows.select("event_type", "n", F.unix_timestamp("w.start").alias("hour"))


@query("""
WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
g AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM s)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n FROM g GROUP BY ALL""")
def session_counts(spark, sf_dir):
    """Sessions of users, ended by six quiet hours, numbered in order."""
    from pyspark.sql import Window as W

    sessions = table(spark, sf_dir, "events").groupBy(F.session_window("ts", "6 hours").alias("w"), "user_id").agg(F.count("*").alias("n"))
    nth = F.row_number().over(W.partitionBy("user_id").orderBy("w.start")).cast("long")
    return sessions.select("user_id", nth.alias("session"), "n")


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, n FROM (SELECT *, min(n) OVER (PARTITION BY user_id) AS m FROM c) WHERE n = m""")
def first_tier_rows(spark, sf_dir):
    """All rows of each key's first tier."""
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return rank.first_tier(counts, "user_id", "n", [F.col("event_type")])
