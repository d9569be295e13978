"""Sections and tables of nested label documents, at any depth, as rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators.rank import first_of
from tessera.session import stage

#: Names under which nothing is looked for.
LEAVES = ("table", "content", "text")
_OBJECT = "schema_of_variant({0}) LIKE 'OBJECT<%'"


@dataclass(frozen=True)
class Source:
    """Where a source keeps its sections: its name in the document, the path of the document's id, and what a section
    calls its text and its subsections (none: it has no subsections)."""

    name: str
    document_id: str
    text: str
    subsections: str | None = None


def _clean(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def sections(df: DataFrame, key: str, doc: str, sources: list[Source], parents: list[str]) -> DataFrame:
    """Rows key, source, section, parent, document_id, text, subsections (array of id, title, text).

    A section is an object below one of the parents. Those without text go, unless the source has subsections and the
    section has some. Of sections of one name in one source, that of the first parent in order stays.
    """
    parsed = df.select(F.col(key).alias("k"), F.try_parse_json(doc).alias("v")).filter("v IS NOT NULL")
    out = None
    for source in sources:
        trees = [F.struct(F.lit(i).alias("rank"), F.lit(p).alias("parent"), F.try_variant_get("v", f'$["{source.name}"]["{p}"]', "variant").alias("tree")) for i, p in enumerate(parents)]
        ident = _clean(F.try_variant_get("v", f"$.{source.name}.{source.document_id}", "string")).alias("document_id")
        rows = parsed.select("k", ident, F.explode(F.array(*trees)).alias("p")).select("k", "document_id", "p.*").filter("tree IS NOT NULL")
        found = df.sparkSession.sql(
            f"SELECT r.*, x.key AS section, x.value AS body FROM {{rows}} r, LATERAL variant_explode(CASE WHEN {_OBJECT.format('r.tree')} THEN r.tree END) x WHERE {_OBJECT.format('x.value')}",
            rows=rows,
        )
        none = F.expr("CAST(array() AS array<struct<id:string,title:string,text:string>>)")
        subs = none
        if source.subsections:
            items = F.coalesce(F.try_variant_get("body", f"$.{source.subsections}", "array<variant>"), F.expr("CAST(array() AS array<variant>)"))
            numbered = F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
            objects = F.filter(numbered, lambda e: F.schema_of_variant(e["x"]).startswith("OBJECT<"))
            field = lambda e, name: F.coalesce(F.try_variant_get(e["x"], f"$.{name}", "string"), F.lit(""))
            subs = F.transform(
                objects,
                lambda e: F.struct(F.concat(F.col("section"), F.lit("_"), e["i"].cast("string")).alias("id"), field(e, "section_title").alias("title"), field(e, source.text).alias("text")),
            )
        body = _clean(F.try_variant_get("body", f"$.{source.text}", "string")).alias("text")
        own = found.select("k", F.lit(source.name).alias("source"), "section", "parent", "rank", "document_id", body, subs.alias("subsections"))
        own = own.filter("text IS NOT NULL OR size(subsections) > 0")
        out = own if out is None else out.unionByName(own)
    first = first_of(out, ["k", "source", "section"], [F.col("rank")]).drop("rank")
    return first.withColumnRenamed("k", key)


def tables(df: DataFrame, key: str, doc: str, source: str) -> DataFrame:
    """Rows key, table_id, section (names joined by dots), number, caption, headers, rows (as JSON texts) of the tables
    below `source`.

    A node with a list under "table" gives its tables and is not gone into; other nodes are, lists included, round by
    round, each over what is still nested. A table's number is that of its caption, else its place in the list. A first
    row that looks like a head becomes the headers, where there are none. Of equal ids the first in order of section and
    place stays.
    """
    spark = df.sparkSession
    level = df.select(F.col(key).alias("k"), F.lit(source).alias("path"), F.try_variant_get(F.try_parse_json(doc), f"$.{source}", "variant").alias("v"))
    level = stage(level.filter(F.expr(_OBJECT.format("v"))))
    found = []
    skip = ", ".join(f"'{x}'" for x in LEAVES)
    while not level.isEmpty():
        listed = stage(level.withColumn("t", F.try_variant_get("v", "$.table", "array<variant>")))
        found.append(listed.filter("size(t) > 0").select("k", "path", F.posexplode("t").alias("place", "item")))
        step = spark.sql(
            f"SELECT r.k, concat(r.path, '.', x.key) AS path, CASE WHEN {_OBJECT.format('x.value')} THEN x.value ELSE y.value END AS v FROM {{rows}} r, LATERAL variant_explode(r.v) x, "
            f"LATERAL variant_explode_outer(CASE WHEN schema_of_variant(x.value) LIKE 'ARRAY%' THEN x.value END) y WHERE coalesce(size(r.t), 0) <= 0 AND x.key NOT IN ({skip})",
            rows=listed,
        )
        level = stage(step.filter("v IS NOT NULL").filter(F.expr(_OBJECT.format("v"))))
    if not found:
        found = [level.select("k", "path", F.lit(0).alias("place"), F.col("v").alias("item"))]
    items = found[0]
    for more in found[1:]:
        items = items.unionByName(more)
    items = items.filter(F.expr(_OBJECT.format("item")))
    caption = _clean(F.try_variant_get("item", "$.caption", "string"))
    said = F.nullif(F.regexp_extract(caption, r"(?i)table\s+(\d+)", 1), F.lit("")).cast("long")
    heads = F.coalesce(F.try_variant_get("item", "$.headers", "array<string>"), F.array().cast("array<string>"))
    rows = F.coalesce(F.try_variant_get("item", "$.rows", "array<variant>"), F.expr("CAST(array() AS array<variant>)"))
    read = items.select("k", "path", "place", caption.alias("caption"), F.coalesce(said, F.col("place").cast("long")).alias("number"), heads.alias("headers"), rows.alias("rows"))
    first = F.try_variant_get(F.get("rows", F.lit(0)), "$", "array<string>")
    promoted = (F.size("headers") == 0) & F.coalesce(text.is_header(first), F.lit(False))
    read = read.withColumn("up", promoted)
    texts = F.transform(F.when(F.col("up"), F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))).otherwise(F.col("rows")), lambda r: F.to_json(r))
    section = F.substring_index("path", ".", -1)
    ident = F.concat_ws("_", F.col("k").cast("string"), section, F.lit("table"), F.col("number").cast("string"))
    out = read.select("k", "path", "place", ident.alias("table_id"), "number", "caption", F.when(F.col("up"), first).otherwise(F.col("headers")).alias("headers"), texts.alias("rows"))
    once = first_of(out, ["table_id"], [F.col("path"), F.col("place"), F.col("caption"), F.to_json(F.struct("rows"))])
    return once.select(F.col("k").alias(key), "table_id", F.col("path").alias("section"), "number", "caption", "headers", "rows")
