"""Matching of names: similarity joins and tiered resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import keys, text
from tessera.operators import passjoin, rank, similarity, vectors
from tessera.operators.resolve import begun
from tessera.plans.base import query
from tessera.sources.tables import table

_NAMES = "n AS (SELECT DISTINCT p_name FROM part)"


def _names(spark, sf_dir, column="p_name"):
    return table(spark, sf_dir, "part").select(F.col("p_name").alias(column)).distinct()


_GRAMS = """
g AS (SELECT p_name, list_distinct(flatten(list_transform(string_split(lower(p_name), ' '), lambda w:
  list_transform(range(1, CAST(length(w) AS BIGINT) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS t FROM n)"""


@query(f"""
WITH {_NAMES}, {_GRAMS}
SELECT x.p_name AS a, y.p_name AS b, round(len(list_intersect(x.t, y.t)) / CAST(len(list_distinct(x.t || y.t)) AS DOUBLE), 6) AS similarity
FROM g x, g y WHERE x.p_name < y.p_name AND len(list_intersect(x.t, y.t)) / CAST(len(list_distinct(x.t || y.t)) AS DOUBLE) >= 0.4""")
def trigram_similarity(spark, sf_dir):
    """Pairs of names of trigram similarity 0.4 or more."""
    n = _names(spark, sf_dir)
    pairs = similarity.trigram_join(n, n, "p_name", "p_name", 0.4).filter("a < b")
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"""
WITH {_NAMES}, {_GRAMS}
SELECT a, b FROM (SELECT x.p_name AS a, y.p_name AS b, row_number() OVER (PARTITION BY x.p_name ORDER BY
  len(list_intersect(x.t, y.t)) / CAST(len(list_distinct(x.t || y.t)) AS DOUBLE) DESC, y.p_name) AS r
FROM g x, g y WHERE x.p_name <> y.p_name AND len(list_intersect(x.t, y.t)) > 0) WHERE r <= 3""")
def trigram_topk(spark, sf_dir):
    """The three most similar names of each name (the feature: a top-k report)."""
    n = _names(spark, sf_dir)
    return similarity.most_similar(n, n, "p_name", "p_name", 3).select("a", "b")


@query(f"""
WITH {_NAMES}, p AS (SELECT x.p_name AS a, y.p_name AS b, levenshtein(x.p_name, y.p_name) AS distance,
  CAST(floor(100 * (1 - levenshtein(x.p_name, y.p_name) / CAST(greatest(length(x.p_name), length(y.p_name)) AS DOUBLE))) AS BIGINT) AS ratio
  FROM n x, n y WHERE x.p_name < y.p_name)
SELECT a, b, distance, ratio, CASE WHEN ratio >= 90 THEN 'high' WHEN ratio >= 75 THEN 'middle' ELSE 'low' END AS band FROM p WHERE distance <= 3""")
def edit_ratio_bands(spark, sf_dir):
    """Pairs of names at an edit distance of 3 or less, banded by ratio."""
    n = _names(spark, sf_dir)
    pairs = passjoin.edit_join(n, n, "p_name", "p_name", 3).filter("a < b").withColumn("ratio", text.edit_ratio(F.col("a"), F.col("b")))
    return pairs.withColumn("band", F.when(F.col("ratio") >= 90, "high").when(F.col("ratio") >= 75, "middle").otherwise("low"))


@query("""
SELECT array_to_string(list_sort(string_split(lower(trim(p_name)), ' ')), ' ') AS key, count(*) AS n, count(DISTINCT p_name) AS spellings FROM part GROUP BY 1""")
def token_sort_equal(spark, sf_dir):
    """Names equal up to the order of their words."""
    return table(spark, sf_dir, "part").groupBy(text.token_sort(F.col("p_name")).alias("key")).agg(
        F.count("*").alias("n"), F.countDistinct("p_name").alias("spellings")
    )


@query("""
WITH f AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS a FROM part), n AS (SELECT DISTINCT p_name AS b FROM part)
SELECT a, b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY length(b), b) AS r FROM f JOIN n ON starts_with(b, a) AND a <> b AND length(a) >= 3) WHERE r = 1""")
def prefix_join(spark, sf_dir):
    """The shortest name that each first word properly starts."""
    first = table(spark, sf_dir, "part").select(F.split("p_name", " ")[0].alias("w")).distinct()
    pairs = begun(first.filter(F.length("w") >= 3), _names(spark, sf_dir), "w", "p_name").toDF("a", "b")
    return rank.first_of(pairs, ["a"], [F.length("b"), F.col("b")])


_ENDINGS = ("gear", "bolt", "ring", "nut")


@query(f"""
SELECT p_partkey, regexp_replace(upper(trim(p_name)), '\\s+(?:{'|'.join(e.upper() for e in _ENDINGS)})S?\\s*$', '') AS name FROM part""")
def suffix_strip(spark, sf_dir):
    """Names without a trailing word of a list."""
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_suffix(F.col("p_name"), _ENDINGS).alias("name"))


_ORDERED = ["^small ", " bolt$", "^red | ring$"]


@query("""
SELECT p_partkey, CASE WHEN length(x) >= 3 THEN x END AS name FROM (SELECT p_partkey, CASE
  WHEN regexp_replace(p_name, '^small ', '', 'g') <> p_name THEN regexp_replace(p_name, '^small ', '', 'g')
  WHEN regexp_replace(p_name, ' bolt$', '', 'g') <> p_name THEN regexp_replace(p_name, ' bolt$', '', 'g')
  WHEN regexp_replace(p_name, '^red | ring$', '', 'g') <> p_name THEN regexp_replace(p_name, '^red | ring$', '', 'g') END AS x FROM part)""")
def suffix_strip_ordered(spark, sf_dir):
    """The first pattern of an ordered list that changes a name."""
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_first(F.col("p_name"), _ORDERED).alias("name"))


@query("""
SELECT CASE p_type WHEN 'ECONOMY' THEN 'BASIC' WHEN 'STANDARD' THEN 'BASIC' WHEN 'PROMO' THEN 'OFFER' ELSE p_type END AS form, count(*) AS n FROM part GROUP BY 1""")
def canonical_form(spark, sf_dir):
    """Values mapped to canonical ones, others as they are."""
    form = text.canonical(F.col("p_type"), {"ECONOMY": "BASIC", "STANDARD": "BASIC", "PROMO": "OFFER"})
    return table(spark, sf_dir, "part").groupBy(form.alias("form")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(lang, ''), coalesce(source, ''))), 1, 16) AS key FROM documents")
def hash_ids(spark, sf_dir):
    """Keys derived from contents."""
    return table(spark, sf_dir, "documents").select("doc_id", keys.short_md5(F.col("doc_id"), F.col("lang"), F.col("source")).alias("key"))


@query("""
WITH h AS (SELECT o_orderkey, sha1(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode(o_orderkey || '|' || o_orderstatus)) AS h FROM orders)
SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  ['8', '9', 'a', 'b'][(instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h""")
def uuid5_ids(spark, sf_dir):
    """Name-based UUIDs of composite keys."""
    seed = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.uuid5(seed).alias("id"))


_WATERFALL = """
WITH w AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN p.p_name WHEN 1 THEN upper(string_split(p.p_name, ' ')[2] || ' ' || string_split(p.p_name, ' ')[1])
    WHEN 2 THEN p.p_name || ' hydrochloride' WHEN 3 THEN string_split(p.p_name, ' ')[1] ELSE 'zzz' END AS name
  FROM customer JOIN part p ON p_partkey = c_custkey),
n AS (SELECT p_name, min(p_partkey) AS id, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS sorted FROM part GROUP BY p_name),
c AS (
  SELECT c_custkey, 1 AS step, id, 'exact' AS label, 0 AS len, p_name FROM w JOIN n ON lower(trim(name)) = p_name
  UNION ALL SELECT c_custkey, 2, id, 'synonym', 0, p_name FROM w JOIN n ON array_to_string(list_sort(string_split(lower(name), ' ')), ' ') = sorted
  UNION ALL SELECT c_custkey, 3, id, 'stripped', 0, p_name FROM w JOIN n ON lower(regexp_replace(upper(name), '\\s+HYDROCHLORIDE$', '')) = p_name
  UNION ALL SELECT c_custkey, 4, id, 'prefix', length(p_name), p_name FROM w JOIN n ON starts_with(p_name, lower(name)) AND p_name <> lower(name) AND length(name) >= 3)"""


def _candidates(spark, sf_dir):
    """Customers with spoilt part names, and candidates for them tier by tier."""
    parts = table(spark, sf_dir, "part")
    which, word = F.col("c_custkey") % 5, F.split("p_name", " ")
    name = (
        F.when(which == 0, F.col("p_name")).when(which == 1, F.upper(F.concat_ws(" ", word[1], word[0])))
        .when(which == 2, F.concat("p_name", F.lit(" hydrochloride"))).when(which == 3, word[0]).otherwise("zzz")
    )
    wanted = table(spark, sf_dir, "customer").join(parts, F.col("p_partkey") == F.col("c_custkey")).select("c_custkey", name.alias("name"))
    known = parts.groupBy("p_name").agg(F.min("p_partkey").alias("id"))

    def tier(step, label, key, other, length=None):
        hit = wanted.withColumn("k", key).join(known.withColumn("k", other), "k")
        return hit.select("c_custkey", F.lit(step).alias("step"), "id", F.lit(label).alias("label"), (length if length is not None else F.lit(0)).alias("len"), "p_name")

    stripped = F.lower(text.strip_suffix(F.col("name"), text.SALTS))
    starts = begun(wanted.select(F.lower("name").alias("w")).filter(F.length("w") >= 3).distinct(), known.select("p_name"), "w", "p_name").toDF("a", "b")
    prefix = (
        wanted.withColumn("a", F.lower("name")).join(starts, "a").join(known, F.col("b") == F.col("p_name"))
        .select("c_custkey", F.lit(4).alias("step"), "id", F.lit("prefix").alias("label"), F.length("p_name").alias("len"), "p_name")
    )
    return (
        wanted,
        tier(1, "exact", F.lower(F.trim("name")), F.col("p_name"))
        .unionByName(tier(2, "synonym", text.token_sort(F.col("name")), text.token_sort(F.col("p_name"))))
        .unionByName(tier(3, "stripped", stripped, F.col("p_name")))
        .unionByName(prefix),
    )


@query(_WATERFALL + """
SELECT c_custkey, name, step, id, label FROM w LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY step, len, p_name) AS r FROM c) WHERE r = 1) USING (c_custkey)""")
def waterfall_match(spark, sf_dir):
    """Names resolved by the first of four tiers that knows them; the rest stays unresolved."""
    wanted, candidates = _candidates(spark, sf_dir)
    best = rank.waterfall(candidates, "c_custkey", "step", [F.col("len"), F.col("p_name")])
    return wanted.join(best, "c_custkey", "left").select("c_custkey", "name", "step", "id", "label")


@query(_WATERFALL + ", m AS (SELECT *, min(step) OVER (PARTITION BY c_custkey) AS best FROM c) SELECT c_custkey, step, id FROM m WHERE step = best")
def resolver_all_rows(spark, sf_dir):
    """All rows of the first tier that knows a name."""
    return rank.first_tier(_candidates(spark, sf_dir)[1], "c_custkey", "step", [F.col("p_name")]).select("c_custkey", "step", "id")


@query("""
WITH q AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS similarity
  FROM q JOIN embeddings e ON e.label = q.label AND e.vec_id <> q.vec_id)
SELECT query_id, vec_id, round(similarity, 4) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS r FROM s) WHERE r <= 5""")
def vector_topk(spark, sf_dir):
    """Five nearest vectors of the same label for every fiftieth vector (the feature: a stated query set, top-k)."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.select("vec_id", F.col("label").alias("grp"), F.col("embedding").alias("vector"))
    queries = rows.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    best = vectors.nearest(rows, queries, 5)
    return best.select("query_id", "vec_id", F.round("similarity", 4).alias("similarity"))
