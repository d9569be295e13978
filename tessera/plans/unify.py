"""Standardised and unified records, fuzzy tiers, doses by profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import fuzzy, rank, records
from tessera.plans.base import query
from tessera.sources.tables import table

#: Source fields of an event's record and where they go: category, field, slot.
_TARGETS = {"k": ("measures", "key", "number"), "label": ("measures", "key", "text"), "kind": ("identity", "kind", "")}

_STANDARD = """
WITH r AS (SELECT event_id, props->>'$.k' AS k, CASE WHEN event_type <> 'view' THEN event_type END AS kind, 'no ' || (event_id % 5) AS label, CASE WHEN event_id % 4 = 0 THEN user_id END AS extra FROM events),
f AS (SELECT event_id, 'measures' AS category, 'key' AS field, 'number' AS slot, k AS value FROM r UNION ALL SELECT event_id, 'measures', 'key', 'text', label FROM r
  UNION ALL SELECT event_id, 'identity', 'kind', '', kind FROM r UNION ALL SELECT event_id, 'unmapped_fields', 'extra', '', CAST(extra AS VARCHAR) FROM r)"""


def _standard(spark, sf_dir):
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    label = F.concat(F.lit("no "), (F.col("event_id") % 5).cast("string"))
    extra = F.when(F.col("event_id") % 4 == 0, F.col("user_id"))
    k = F.get_json_object("props", "$.k").cast("long")
    doc = F.to_json(F.struct(k.alias("k"), kind.alias("kind"), label.alias("label"), extra.alias("extra")), {"ignoreNullFields": "false"})
    return table(spark, sf_dir, "events").select("event_id", records.standardise(doc, _TARGETS).alias("items"))


@query(_STANDARD + " SELECT event_id, category, field, slot, value FROM f WHERE value IS NOT NULL")
def standardised_fields(spark, sf_dir):
    """Source fields under their standard category, field and slot; unknown ones are kept apart, nulls dropped."""
    return _standard(spark, sf_dir).select("event_id", F.inline("items"))


@query(_STANDARD + """
SELECT event_id, max(value) FILTER (WHERE slot = 'number') AS number, max(value) FILTER (WHERE slot = 'text') AS label,
  max(value) FILTER (WHERE field = 'kind') AS kind, max(value) FILTER (WHERE field = 'extra') AS extra, count(DISTINCT category) AS categories
FROM f WHERE value IS NOT NULL GROUP BY event_id""")
def standardised_records(spark, sf_dir):
    """The same fields as one nested record for each event."""
    rows = _standard(spark, sf_dir).select("event_id", records.nested(F.col("items")).alias("r"))

    def at(category, field, slot):
        return F.try_element_at(F.try_element_at(F.try_element_at("r", F.lit(category)), F.lit(field)), F.lit(slot))

    return rows.select(
        "event_id",
        at("measures", "key", "number").alias("number"),
        at("measures", "key", "text").alias("label"),
        at("identity", "kind", "").alias("kind"),
        at("unmapped_fields", "extra", "").alias("extra"),
        F.size("r").cast("long").alias("categories"),
    )


@query("""
WITH l AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS main, upper(trim(p_name)) AS name, l_linestatus, l_quantity FROM lineitem LEFT JOIN part ON p_partkey = l_partkey),
n AS (SELECT l_orderkey, list_sort(coalesce(list(DISTINCT name) FILTER (WHERE main = 1 AND name <> ''), [])) AS a,
  list_sort(coalesce(list(DISTINCT name) FILTER (WHERE main = 0 AND name <> ''), [])) AS o, count(DISTINCT (l_linestatus, l_quantity)) AS tables FROM l GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE c_mktsegment END AS title, array_to_string(coalesce(a, []), ',') AS actives,
  array_to_string(list_filter(coalesce(o, []), lambda x: NOT list_contains(coalesce(a, []), x)), ',') AS inactives, coalesce(tables, 0) AS tables,
  CASE WHEN len(list_filter(coalesce(a, []), lambda x: contains(x, 'RING') OR contains('RING', x))) > 0 THEN 'active' ELSE 'excipient' END AS ring_role
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN n ON l_orderkey = o_orderkey""")
def unified_records(spark, sf_dir):
    """One record for each order from four sources: text by preference, distinct main and other names, distinct tables, roles."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf_dir, "lineitem").join(parts, "l_partkey", "left")
    main = F.col("l_returnflag") == "R"
    names = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_set(F.when(main, F.col("p_name"))).alias("a"),
        F.collect_set(F.when(~main, F.col("p_name"))).alias("o"),
        F.collect_set(F.struct(F.col("l_linestatus").alias("caption"), F.col("l_quantity").alias("row"))).alias("t"),
    )
    buyers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    none = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "orders").join(buyers, "o_custkey", "left").join(names, "o_orderkey", "left")
    rows = rows.withColumn("a", records.main_names(F.coalesce("a", none)))
    title = records.first_text(F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")), F.col("c_mktsegment"))
    return rows.select(
        "o_orderkey",
        title.alias("title"),
        F.array_join("a", ",").alias("actives"),
        F.array_join(records.other_names(F.coalesce("o", none), F.col("a")), ",").alias("inactives"),
        F.coalesce(F.size("t"), F.lit(0)).cast("long").alias("tables"),
        records.role_of(F.lit("ring"), F.col("a")).alias("ring_role"),
    )


@query("""
WITH k AS (SELECT title, min(id) AS id FROM (SELECT lower(p_name || ' ' || p_type || ' ' || p_brand) AS title, p_partkey AS id FROM part UNION ALL SELECT lower(p_type), p_partkey FROM part) GROUP BY title),
w AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Item (' || t || ')' WHEN 1 THEN substr(t, 1, 5) || substr(t, 7) WHEN 2 THEN 'zz-' || p_type || ' qq'
    WHEN 3 THEN substr(t, 1, 9) || 'jjj' || substr(t, 13) WHEN 4 THEN t || ' extended release' ELSE 'qqqq' END AS name
  FROM (SELECT *, lower(p_name || ' ' || p_type || ' ' || p_brand) AS t FROM part) JOIN customer ON c_custkey = p_partkey),
n AS (SELECT DISTINCT name, lower(trim(name)) AS q FROM w),
s AS (SELECT name, title, id, CAST(floor(100 * (greatest(length(q), length(title)) - levenshtein(q, title)) / greatest(length(q), length(title))) AS BIGINT) AS score FROM n, k
  WHERE abs(length(q) - length(title)) <= 0.15 * greatest(length(q), length(title))),
c AS (SELECT name, 1 AS step, title, id, 100 AS score FROM n JOIN k ON title = lower(trim(regexp_extract(name, '\\(([^)]+)\\)', 1)))
  UNION ALL SELECT name, 3, title, id, 100 FROM (SELECT name, unnest(regexp_split_to_array(q, '[\\s\\-/]+')) AS tok FROM n) JOIN k ON title = tok AND length(tok) >= 6
  UNION ALL SELECT name, CASE WHEN score >= 95 THEN 2 ELSE 4 END, title, id, score FROM s WHERE score >= 85),
r AS (SELECT name, length(q) AS lq, q, length(title) AS lt, title, id FROM n, k WHERE name NOT IN (SELECT name FROM c) AND least(length(q), length(title)) >= 3),
p AS (SELECT name, title, id, list_max(list_transform(range(1, abs(lq - lt) + 2), lambda i: CAST(floor(100 * (least(lq, lt) - CASE WHEN lq <= lt THEN levenshtein(q, substr(title, i, lq)) ELSE levenshtein(title, substr(q, i, lt)) END) / least(lq, lt)) AS BIGINT))) AS score FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY step, score DESC, length(title), title) AS nth FROM (SELECT * FROM c UNION ALL SELECT name, 5, title, id, score FROM p WHERE score >= 90))
SELECT c_custkey, w.name, step, id, title, CAST(score AS BIGINT) AS score FROM w LEFT JOIN b ON b.name = w.name AND nth = 1""")
def fuzzy_five_tiers(spark, sf_dir):
    """Names resolved by parentheses, high ratio, token, middle ratio or partial ratio; the first tier that finds one wins."""
    full = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    parts = table(spark, sf_dir, "part")
    titles = parts.select(full.alias("title"), "p_partkey").unionByName(parts.select(F.lower("p_type").alias("title"), "p_partkey"))
    known = titles.groupBy("title").agg(F.min("p_partkey").alias("id"))
    which, t = F.col("c_custkey") % 6, F.col("t")
    name = (
        F.when(which == 0, F.concat(F.lit("Item ("), t, F.lit(")"))).when(which == 1, F.concat(F.substring(t, 1, 5), F.expr("substring(t, 7)")))
        .when(which == 2, F.concat(F.lit("zz-"), "p_type", F.lit(" qq"))).when(which == 3, F.concat(F.substring(t, 1, 9), F.lit("jjj"), F.expr("substring(t, 13)")))
        .when(which == 4, F.concat(t, F.lit(" extended release"))).otherwise("qqqq")
    )
    spoilt = table(spark, sf_dir, "customer").join(parts.withColumn("t", full), F.col("p_partkey") == F.col("c_custkey")).select("c_custkey", name.alias("name"))
    best = fuzzy.five_tiers(spoilt, known, "name", "title", "id")
    return spoilt.join(best, "name", "left").select("c_custkey", "name", "step", "id", "title", "score")


_DOSES = """
WITH p AS (SELECT c_custkey, c_mktsegment, c_custkey % 90 AS age, 40 + c_custkey % 60 AS kg FROM customer),
r AS (SELECT * FROM (VALUES (1, 0, 200, 'any', 2.0, 150.0), (2, 0, 17, 'any', 1.5, 60.0), (3, 65, 200, 'any', 1.0, 80.0), (4, 65, 200, 'BUILDING', 0.5, 40.0)) AS t(rule, lo, hi, segment, per_kg, most))"""


@query(_DOSES + """, b AS (SELECT p.*, r.*, row_number() OVER (PARTITION BY c_custkey ORDER BY (lo > 0 OR hi < 200)::INT + (segment <> 'any')::INT DESC, rule) AS nth
  FROM p JOIN r ON age BETWEEN lo AND hi AND segment IN (c_mktsegment, 'any')),
s AS (SELECT c_custkey, rule, least(kg * per_kg, most)::DOUBLE AS dose, unnest([10.0, 25.0, 50.0, 100.0])::DOUBLE AS strength FROM b WHERE nth = 1)
SELECT c_custkey, rule, dose, strength FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(dose - strength), strength) AS n FROM s) WHERE n = 1""")
def profile_doses(spark, sf_dir):
    """The most specific dosing rule of each profile, its dose by weight up to a maximum, and the nearest strength."""
    age, kg = F.col("c_custkey") % 90, F.col("c_custkey") % 60 + 40
    old = age >= 65
    rule = rank.most_specific([(1, []), (2, [age <= 17]), (3, [old]), (4, [old, F.col("c_mktsegment") == "BUILDING"])])["rule"]
    doses = {1: (2.0, 150.0), 2: (1.5, 60.0), 3: (1.0, 80.0), 4: (0.5, 40.0)}
    by_weight = F.coalesce(*[F.when(F.col("rule") == r, F.least(F.col("kg") * per, F.lit(most))) for r, (per, most) in doses.items()])
    rows = table(spark, sf_dir, "customer").select("c_custkey", kg.alias("kg"), rule.alias("rule")).withColumn("dose", by_weight)
    return rows.select("c_custkey", "rule", "dose", text.nearest(F.col("dose"), [10.0, 25.0, 50.0, 100.0]).alias("strength"))
