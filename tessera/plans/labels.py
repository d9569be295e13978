"""Sections and tables of nested label documents, made of conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import labels
from tessera.plans.base import query
from tessera.sources.tables import table

#: A label of each conversation: a flat source with two parents that share some sections, and a deep one with
#: subsections and tables inside sections, lists and further sections.
_LABELS = """
WITH t AS (SELECT *, role || '_' || turn AS name, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS lines FROM conversations),
safe AS (SELECT conv_id, json_group_object(name, json_object('text', CASE WHEN turn % 3 = 0 THEN ' ' ELSE left(text, 60) END)) AS o FROM t WHERE turn % 2 = 0 GROUP BY conv_id),
clin AS (SELECT conv_id, json_group_object(name, json_object('text', left(text, 30))) AS o FROM t WHERE turn % 4 <> 2 GROUP BY conv_id),
deep AS (
  SELECT conv_id, json_group_object(name, json_object('content', CASE WHEN turn % 3 = 1 THEN '' ELSE left(text, 50) END,
    'subsections', list_transform(lines[2:], lambda x: json_object('section_title', left(x, 5), 'content', x)),
    'parts', [json_object('table', list_transform(lines[3:], lambda x: json_object('caption', CASE WHEN length(x) % 2 = 0 THEN 'Table ' || (length(x) % 4) || '. ' || left(x, 9) ELSE '' END,
       'headers', [], 'rows', [[CASE WHEN length(x) % 3 = 0 THEN 'n' ELSE 'age' END, '%'], [CAST(length(x) AS VARCHAR), left(x, 3)]])), 'more', json_object('table', [json_object('caption', 'hidden')]))])) AS o
  FROM t GROUP BY conv_id),
docs AS (
  SELECT conv_id, json_object(
    'flat', json_object('ident', json_object('set_id', CASE WHEN conv_id % 3 > 0 THEN 'd' || conv_id ELSE ' ' END), 'safety', coalesce(safe.o, json_object()), 'clinical', coalesce(clin.o, json_object())),
    'deep', json_object('ident', json_object('set_id', 'e' || conv_id), 'safety', deep.o)) AS doc
  FROM deep LEFT JOIN safe USING (conv_id) LEFT JOIN clin USING (conv_id))"""


def _labels(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))

    def by_name(keep, body):
        entry = lambda x: F.struct(F.concat_ws("_", x["role"], x["turn"].cast("string")), body(x))
        return F.map_from_entries(F.transform(F.filter("t", keep), entry))

    def lines(x, skip):
        full = F.filter(F.split(x["text"], "\n"), lambda line: line != "")
        return F.slice(full, skip + 1, 1 << 30)

    def one_table(x):
        n = F.length(x)
        caption = F.when(n % 2 == 0, F.concat(F.lit("Table "), (n % 4).cast("string"), F.lit(". "), F.left(x, F.lit(9)))).otherwise("")
        cells = F.array(F.array(F.when(n % 3 == 0, "n").otherwise("age"), F.lit("%")), F.array(n.cast("string"), F.left(x, F.lit(3))))
        return F.struct(caption.alias("caption"), F.array().cast("array<string>").alias("headers"), cells.alias("rows"))

    def part(x):
        hidden = F.struct(F.array(F.struct(F.lit("hidden").alias("caption"))).alias("table"))
        return F.struct(F.transform(lines(x, 2), one_table).alias("table"), hidden.alias("more"))

    def section(x):
        subs = F.transform(lines(x, 1), lambda line: F.struct(F.left(line, F.lit(5)).alias("section_title"), line.alias("content")))
        content = F.when(x["turn"] % 3 == 1, "").otherwise(F.left(x["text"], F.lit(50)))
        return F.struct(content.alias("content"), subs.alias("subsections"), F.array(part(x)).alias("parts"))

    flat_id = F.when(F.col("conv_id") % 3 > 0, F.concat(F.lit("d"), F.col("conv_id").cast("string"))).otherwise(" ")
    safety = by_name(lambda x: x["turn"] % 2 == 0, lambda x: F.struct(F.when(x["turn"] % 3 == 0, " ").otherwise(F.left(x["text"], F.lit(60))).alias("text")))
    clinical = by_name(lambda x: x["turn"] % 4 != 2, lambda x: F.struct(F.left(x["text"], F.lit(30)).alias("text")))
    flat = F.struct(F.struct(flat_id.alias("set_id")).alias("ident"), safety.alias("safety"), clinical.alias("clinical"))
    deep_id = F.concat(F.lit("e"), F.col("conv_id").cast("string"))
    deep = F.struct(F.struct(deep_id.alias("set_id")).alias("ident"), by_name(lambda x: F.lit(True), section).alias("safety"))
    return rows.select("conv_id", F.to_json(F.struct(flat.alias("flat"), deep.alias("deep"))).alias("doc"))


@query(_LABELS + """,
found AS (
  SELECT conv_id, 'flat' AS source, e.key AS section, p AS parent, nullif(trim(doc->'flat'->'ident'->>'set_id'), '') AS document_id, nullif(trim(e.value->>'text'), '') AS text, 0 AS n_subsections, '' AS subsections, r
  FROM docs, (VALUES (0, 'safety'), (1, 'clinical')) v(r, p), json_each(doc->'flat'->p) e
  UNION ALL
  SELECT conv_id, 'deep', e.key, 'safety', doc->'deep'->'ident'->>'set_id', nullif(trim(e.value->>'content'), ''), json_array_length(e.value->'subsections'),
    array_to_string(list_transform(range(0, CAST(json_array_length(e.value->'subsections') AS BIGINT)), lambda i: e.key || '_' || i || '=' || (e.value->'subsections'->i->>'section_title') || ':' || (e.value->'subsections'->i->>'content')), '|'), 0
  FROM docs, json_each(doc->'deep'->'safety') e)
SELECT conv_id, source, section, parent, document_id, text, CAST(n_subsections AS BIGINT) AS n_subsections, subsections FROM found WHERE text IS NOT NULL OR n_subsections > 0
QUALIFY row_number() OVER (PARTITION BY conv_id, source, section ORDER BY r) = 1""")
def label_sections(spark, sf_dir):
    """Sections of both sources as one table, with their subsections; blank ones and those of later parents are left out."""
    sources = [labels.Source("flat", "ident.set_id", "text"), labels.Source("deep", "ident.set_id", "content", "subsections")]
    rows = labels.sections(_labels(spark, sf_dir), "conv_id", "doc", sources, ["safety", "clinical"])
    shown = F.transform("subsections", lambda s: F.concat(s["id"], F.lit("="), s["title"], F.lit(":"), s["text"]))
    return rows.withColumn("n_subsections", F.size("subsections").cast("long")).withColumn("subsections", F.array_join(shown, "|"))


@query(_LABELS + """,
items AS (
  SELECT conv_id, 'deep.safety.' || e.key || '.parts' AS section, CAST(i AS BIGINT) AS place, e.value->'parts'->0->'table'->i AS item
  FROM docs, json_each(doc->'deep'->'safety') e, LATERAL (SELECT unnest(range(0, CAST(json_array_length(e.value->'parts'->0->'table') AS BIGINT))) AS i)
  UNION ALL
  SELECT conv_id, 'deep.safety.' || e.key || '.parts.more', 0, e.value->'parts'->0->'more'->'table'->0
  FROM docs, json_each(doc->'deep'->'safety') e WHERE json_array_length(e.value->'parts'->0->'table') = 0),
read AS (
  SELECT conv_id, section, place, item, nullif(trim(item->>'caption'), '') AS caption, coalesce(TRY_CAST(nullif(regexp_extract(item->>'caption', '(?i)table\\s+(\\d+)', 1), '') AS BIGINT), place) AS number,
    coalesce(json_extract_string(item, '$.rows[0][0]') = 'n', false) AS up FROM items)
SELECT conv_id, conv_id || '_' || string_split(section, '.')[-1] || '_table_' || number AS table_id, section, number, caption, CASE WHEN up THEN 'n,%' ELSE '' END AS headers,
  CASE WHEN json_extract(item, '$.rows') IS NULL THEN '' WHEN up THEN CAST(json_extract(item, '$.rows[1]') AS VARCHAR) ELSE CAST(json_extract(item, '$.rows[0]') AS VARCHAR) || CAST(json_extract(item, '$.rows[1]') AS VARCHAR) END AS rows
FROM read QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY section, place) = 1""")
def label_tables(spark, sf_dir):
    """Tables found at any depth of the deep source; what lies below a node with tables is not gone into."""
    rows = labels.tables(_labels(spark, sf_dir), "conv_id", "doc", "deep")
    return rows.withColumn("headers", F.array_join("headers", ",")).withColumn("rows", F.array_join("rows", ""))
