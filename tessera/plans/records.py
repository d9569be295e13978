"""Nested records: fills by path, diffs, sections, tables, identifiers, migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import trees
from tessera.plans.base import query
from tessera.session import stage
from tessera.sources.tables import table

#: Each turn as a nested document with gaps of every kind, a dotted name, text that looks like JSON, and arrays.
_DOCS = """
WITH docs AS (
  SELECT conv_id * 1000 + turn AS id, conv_id, turn, json_object(
    'speaker', CASE WHEN turn % 4 = 1 THEN ' ' ELSE role END,
    'body', json_object('text', CASE WHEN turn % 3 > 0 THEN left(text, 40) END,
                        'stats', json_object('chars', length(text), 'lines', list_transform(list_filter(string_split(text, chr(10))[2:], lambda x: x <> ''), lambda x: length(x)))),
    'a.k', turn, 'note', '{' || left(text, 12),
    'tags', CASE WHEN turn % 2 = 0 THEN json_object() ELSE json_object('role', role, 'turn.no', CAST(turn AS VARCHAR)) END) AS doc
  FROM conversations),
tree AS (SELECT d.id, d.conv_id, t.fullkey AS path, t.type, CAST(t.value AS VARCHAR) AS value FROM docs d, json_tree(d.doc) t WHERE t.fullkey <> '$'),
nodes AS (SELECT * FROM tree WHERE NOT regexp_matches(path, '\\[\\d+\\]')),
leaves AS (SELECT *, value IN ('null', '[]', '{}') OR (type = 'VARCHAR' AND trim(value, '" ') = '') AS gap FROM nodes WHERE type <> 'OBJECT' OR value = '{}')"""


def _documents(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    lines = F.filter(F.slice(F.split("text", "\n"), 2, 1 << 30), lambda x: x != "")
    nothing = F.create_map().cast("map<string,string>")
    tags = F.when(F.col("turn") % 2 == 0, nothing).otherwise(F.create_map(F.lit("turn.no"), F.col("turn").cast("string"), F.lit("role"), F.col("role")))
    doc = F.struct(
        F.when(F.col("turn") % 4 == 1, " ").otherwise(F.col("role")).alias("speaker"),
        F.struct(
            F.when(F.col("turn") % 3 > 0, F.left("text", F.lit(40))).alias("text"),
            F.struct(F.length("text").alias("chars"), F.transform(lines, F.length).alias("lines")).alias("stats"),
        ).alias("body"),
        F.col("turn").alias("a.k"),
        F.concat(F.lit("{"), F.left("text", F.lit(12))).alias("note"),
        tags.alias("tags"),
    )
    ident = (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    return rows.select(ident, "conv_id", "turn", F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"))


_DECIDED = _DOCS + """,
donors AS (
  SELECT l.conv_id, l.path, n.value, n.id, row_number() OVER (PARTITION BY l.conv_id, l.path ORDER BY length(n.value) DESC, n.id) AS r,
         count(*) OVER (PARTITION BY l.conv_id, l.path) AS n
  FROM (SELECT DISTINCT conv_id, path FROM leaves WHERE gap) l JOIN nodes n USING (conv_id, path)
  WHERE NOT (n.value IN ('null', '[]', '{}') OR (n.type = 'VARCHAR' AND trim(n.value, '" ') = ''))),
x AS (
  SELECT l.id, l.path, l.value AS original_value, d.value AS filled_value, d.id AS source_key, coalesce(d.n, 0) AS sibling_count,
         CASE WHEN d.id IS NULL THEN 'skipped_no_sibling_value' ELSE 'filled' END AS status
  FROM leaves l LEFT JOIN donors d ON d.conv_id = l.conv_id AND d.path = l.path AND d.r = 1 WHERE l.gap)"""


@query(_DECIDED + " SELECT * FROM x")
def sibling_path_decisions(spark, sf_dir):
    """The gaps inside documents, at any depth, and what the documents of the same conversation offer for each."""
    decided = trees.fill_decisions(_documents(spark, sf_dir), "id", ["conv_id"], "doc")
    return decided.withColumn("path", trees.rendered(F.col("path")))


@query(_DECIDED + """,
after AS (
  SELECT l.path, l.value FROM leaves l LEFT JOIN x USING (id, path) WHERE x.filled_value IS NULL
  UNION ALL SELECT x.path || substr(t.fullkey, 2), CAST(t.value AS VARCHAR) FROM x, json_tree(x.filled_value) t
  WHERE x.status = 'filled' AND NOT regexp_matches(t.fullkey, '\\[\\d+\\]') AND (t.type <> 'OBJECT' OR CAST(t.value AS VARCHAR) = '{}'))
SELECT path, count(*) AS n, count(*) FILTER (WHERE value IN ('null', '[]', '{}', '" "')) AS gaps, count(DISTINCT value) AS values FROM after GROUP BY path""")
def sibling_path_apply(spark, sf_dir):
    """The documents rebuilt with their fills, as counts by path."""
    docs = stage(_documents(spark, sf_dir))
    decided = stage(trees.fill_decisions(docs, "id", ["conv_id"], "doc"))
    leaves = trees.walk(trees.enrich(docs, "id", "doc", decided), "id", "doc")
    return leaves.groupBy(trees.rendered(F.col("path")).alias("path")).agg(
        F.count("*").alias("n"), F.count_if(trees.is_gap(F.col("value"))).alias("gaps"), F.countDistinct("value").alias("values")
    )


@query(_DECIDED + " SELECT id, count(*) AS n, string_agg(path || '=' || filled_value, ',' ORDER BY path) AS fills FROM x WHERE status = 'filled' GROUP BY id")
def fill_maps(spark, sf_dir):
    """The fills of each document as one map."""
    maps = trees.fill_maps(trees.fill_decisions(_documents(spark, sf_dir), "id", ["conv_id"], "doc"), "id")
    entries = F.transform(F.array_sort(F.map_entries("fills")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select("id", F.size("fills").cast("long").alias("n"), F.array_join(entries, ",").alias("fills"))


@query(_DOCS + """
SELECT regexp_replace(path, '\\[\\d+\\]', '[*]', 'g') AS path, count(*) AS n, count(*) FILTER (WHERE type = 'OBJECT') AS n_object,
  count(*) FILTER (WHERE type = 'ARRAY') AS n_array, count(*) FILTER (WHERE type = 'VARCHAR') AS n_string, count(*) FILTER (WHERE type = 'NULL') AS n_null,
  count(*) FILTER (WHERE type LIKE '%INT') AS n_number, count(DISTINCT CASE WHEN type NOT IN ('OBJECT', 'ARRAY') THEN value END) AS values
FROM tree GROUP BY 1""")
def path_catalogue(spark, sf_dir):
    """Every path of nested documents, into arrays too, with counts of nodes by kind and of distinct values."""
    paths = trees.catalogue(_documents(spark, sf_dir), "id", "doc")
    return paths.select(trees.rendered(F.col("path")).alias("path"), "n", "n_object", "n_array", "n_string", "n_null", "n_number", "values")


@query(_DOCS + """,
b AS (SELECT id, path, value FROM leaves), a AS (SELECT id - 1 AS id, path, value FROM leaves WHERE id % 1000 > 0)
SELECT id, path, CASE WHEN a.value IS NULL THEN 'lost' WHEN b.value IS NULL THEN 'added' ELSE 'changed' END AS change, b.value AS old, a.value AS new
FROM b FULL JOIN a USING (id, path) WHERE a.value IS DISTINCT FROM b.value""")
def deep_diff(spark, sf_dir):
    """Values lost, added and changed between the document of each turn and that of the next."""
    docs = _documents(spark, sf_dir)
    after = docs.filter("turn > 0").withColumn("id", F.col("id") - 1)
    out = trees.differences(docs, after, "id", "doc")
    return out.withColumn("path", trees.rendered(F.col("path")))


@query(_DOCS + """,
deep AS (SELECT path, max(CASE WHEN type = 'OBJECT' OR type = 'ARRAY' THEN 1 ELSE 0 END) AS opens FROM (
  SELECT regexp_replace(path, '\\[\\d+\\]', '', 'g') AS path, CASE WHEN regexp_matches(path, '\\]$') AND type NOT IN ('OBJECT', 'ARRAY') THEN 'OBJECT' ELSE type END AS type FROM tree) GROUP BY path),
shape AS (SELECT path, opens FROM deep d WHERE NOT EXISTS (SELECT 1 FROM deep e WHERE starts_with(e.path, d.path || '.')))
SELECT path, CASE opens WHEN 1 THEN '{}' ELSE 'null' END AS value FROM shape""")
def schema_template(spark, sf_dir):
    """The one document that the shapes of all documents fit into, as its leaves."""
    merged = trees.template(trees.catalogue(_documents(spark, sf_dir), "id", "doc")).withColumn("id", F.lit(0))
    return trees.walk(merged, "id", "doc").select(trees.rendered(F.col("path")).alias("path"), "value")


@query("""
SELECT o_custkey, status, count(*) AS n, round(sum(price), 2) AS price FROM (SELECT o_custkey, o_orderstatus AS status, o_totalprice AS price FROM orders) GROUP BY ALL""")
def json_array_expand(spark, sf_dir):
    """JSON arrays of objects expanded to typed rows."""
    item = F.to_json(F.collect_list(F.struct(F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))))
    docs = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(item.alias("doc"))
    rows = docs.select("o_custkey", F.explode(F.from_json("doc", "array<struct<s:string,p:double>>")).alias("x"))
    return rows.groupBy("o_custkey", F.col("x.s").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("x.p"), 2).alias("price"))


@query("""
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE list_contains(json_keys(props), 'k')) AS has_k, 0::BIGINT AS has_items,
  count(*) FILTER (WHERE CAST(props->>'$.k' AS BIGINT) > 50) AS has_high FROM events GROUP BY event_type""")
def presence_flags(spark, sf_dir):
    """Flags of JSON presence and of arrays that are not empty."""
    items = F.size(F.coalesce(F.from_json(F.get_json_object("props", "$.items"), "array<string>"), F.array().cast("array<string>"))) > 0
    high = F.get_json_object("props", "$.k").cast("long") > 50
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.array_contains(F.json_object_keys("props"), "k")).alias("has_k"),
        F.count_if(items).alias("has_items"),
        F.count_if(high).alias("has_high"),
    )


_LINES = "SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations"


@query(f"""
SELECT conv_id || '.' || turn || '.' || i AS section, length(line) AS chars FROM ({_LINES}) WHERE trim(line) <> ''""")
def flat_subsections(spark, sf_dir):
    """Nested sections flattened to rows with dotted ids; blank ones are left out."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    ident = F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string"), (F.col("i") + 1).cast("string"))
    return rows.filter(F.trim("line") != "").select(ident.alias("section"), F.length("line").cast("long").alias("chars"))


@query("""
SELECT origin, section, count(*) AS n, CAST(sum(length(body)) AS BIGINT) AS chars FROM (
  SELECT 'dialogue' AS origin, role AS section, text AS body FROM conversations WHERE trim(coalesce(text, '')) <> ''
  UNION ALL SELECT 'page', regexp_extract(html, 'lang="([a-z]+)"', 1), regexp_extract(html, '<title>([^<]*)</title>', 1) FROM pages WHERE trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) <> '')
GROUP BY ALL""")
def normalised_sections(spark, sf_dir):
    """Two sources with different text fields as one table of sections; blank sections are left out."""
    talk = table(spark, sf_dir, "conversations").select(F.lit("dialogue").alias("origin"), F.col("role").alias("section"), F.col("text").alias("body"))
    title, lang = F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    page = table(spark, sf_dir, "pages").select(F.lit("page").alias("origin"), lang.alias("section"), title.alias("body"))
    rows = talk.unionByName(page).filter(F.trim(F.coalesce("body", F.lit(""))) != "")
    return rows.groupBy("origin", "section").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("chars"))


@query("""
WITH c AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Table ' || (o_orderkey % 7) || '. Prices' ELSE 'Prices' END AS caption FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 7 ELSE row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS number,
  o_orderkey % 3 = 0 AS promoted FROM c""")
def table_records(spark, sf_dir):
    """Tables with a number from the caption or else their place, and a head row found by its cells."""
    from pyspark.sql import Window as W

    even = F.col("o_orderkey") % 2 == 0
    caption = F.when(even, F.concat(F.lit("Table "), (F.col("o_orderkey") % 7).cast("string"), F.lit(". Prices"))).otherwise("Prices")
    head = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("n"), F.lit(" % "), F.lit("N%"))).otherwise(F.array(F.lit("n"), F.lit("12"), F.lit("%")))
    place = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long")
    said = F.nullif(F.regexp_extract(caption, r"(?i)table\s+(\d+)", 1), F.lit("")).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(said, place).alias("number"), text.is_header(head).alias("promoted"))


_CODES = """
WITH c AS (SELECT p_partkey, p_name, p_brand, p_size FROM part),
sole AS (SELECT p_brand || '-' || p_size AS k, min(p_partkey) AS id FROM c GROUP BY ALL HAVING count(*) = 1),
f AS (SELECT p_name AS k, min(p_partkey) AS id FROM c GROUP BY p_name)"""


@query(_CODES + """
SELECT 'direct' AS id_type, p_partkey::VARCHAR AS value, p_partkey AS owner FROM c
UNION ALL SELECT 'sole', p_brand || '-' || p_size, sole.id FROM c JOIN sole ON sole.k = p_brand || '-' || p_size
UNION ALL SELECT DISTINCT 'first', p_name, f.id FROM c JOIN f ON f.k = p_name
UNION ALL SELECT DISTINCT 'prefix', regexp_extract(p_brand, '^[^#]*#', 0) || p_size, p_partkey FROM c""")
def identifier_fanout(spark, sf_dir):
    """Identifiers of several types, each assigned by its own policy: direct, sole owner, first owner, all owners."""
    parts = table(spark, sf_dir, "part")
    code = F.concat_ws("-", "p_brand", F.col("p_size").cast("string"))
    direct = parts.select(F.lit("direct").alias("id_type"), F.col("p_partkey").cast("string").alias("value"), F.col("p_partkey").alias("owner"))
    coded = parts.groupBy(code.alias("value")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("owner"))
    sole = coded.filter("n = 1").select(F.lit("sole").alias("id_type"), "value", "owner")
    first = parts.groupBy(F.col("p_name").alias("value")).agg(F.min("p_partkey").alias("owner")).select(F.lit("first").alias("id_type"), "value", "owner")
    head = F.concat(F.regexp_extract("p_brand", "^[^#]*#", 0), F.col("p_size").cast("string"))
    every = parts.select(F.lit("prefix").alias("id_type"), head.alias("value"), F.col("p_partkey").alias("owner")).distinct()
    return direct.unionByName(sole).unionByName(first).unionByName(every)


@query("""
SELECT 'event' AS target, count(DISTINCT event_id) AS n FROM events UNION ALL SELECT 'property', count(*) FROM events WHERE list_contains(json_keys(props), 'k')
UNION ALL SELECT 'link', count(*) FROM (SELECT DISTINCT user_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events JOIN customer ON c_custkey = CAST(props->>'$.k' AS BIGINT))""")
def json_migration(spark, sf_dir):
    """JSON records taken apart into three relational tables; unresolved partners drop out of the links."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.from_json("props", "k long")["k"].alias("k"))
    events = rows.select("event_id").distinct()
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    tables = {"event": events, "property": rows.filter("k IS NOT NULL"), "link": rows.select("user_id", "k").distinct().join(known, "k")}
    out = None
    for name, t in tables.items():
        row = t.agg(F.count("*").alias("n")).select(F.lit(name).alias("target"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("""
SELECT doc_id, CASE WHEN length(text) <= 400 THEN 1 ELSE CAST(ceil((length(text) - 400) / 300.0) AS BIGINT) + 1 END AS chunks FROM documents""")
def overlapping_windows(spark, sf_dir):
    """Windows of 400 characters with an overlap of 100, counted by document."""
    n = F.length("text")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), n - 100), F.lit(300))
    windows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.transform(starts, lambda i: F.substring(F.col("text"), i, F.lit(400)))).alias("w"))
    return windows.groupBy("doc_id").agg(F.count("*").alias("chunks"))


@query("""
SELECT conv_id, count(*) AS turns, string_agg(hours, ',' ORDER BY turn) AS separations FROM (
  SELECT conv_id, turn, (turn % 3 + 1) || 'h' AS hours FROM conversations) GROUP BY conv_id""")
def separation_items(spark, sf_dir):
    """Separations in hours taken from a JSON array of notes."""
    note = F.concat(F.lit("leave "), (F.col("turn") % 3 + 1).cast("string"), F.lit(" hours between doses"))
    docs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("turn", note.alias("note"))))).alias("doc"))
    rows = docs.select("conv_id", F.explode(F.from_json("doc", "array<struct<turn:long,note:string>>")).alias("x"))
    hours = F.concat(F.regexp_extract("x.note", r"(\d+) hours?", 1), F.lit("h"))
    items = F.array_sort(F.collect_list(F.struct(F.col("x.turn").alias("turn"), hours.alias("h"))))
    return rows.groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_join(F.transform(items, lambda i: i["h"]), ",").alias("separations"))
