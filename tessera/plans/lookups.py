"""Lookups, guards, fallbacks and report templates over the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import rank, resolve
from tessera.plans.base import query
from tessera.sources.tables import table


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200")
def ordered_page(spark, sf_dir):
    """The third page of a hundred rows (the feature: pagination in a total order)."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(200).limit(100)


@query("SELECT p_type, count(*) AS n FROM part WHERE p_type NOT IN ('PROMO', 'MEDIUM') AND p_name NOT LIKE '%bolt' GROUP BY p_type")
def denylist(spark, sf_dir):
    """Rows outside a list of constants and a list of endings."""
    rows = table(spark, sf_dir, "part").filter(~F.col("p_type").isin("PROMO", "MEDIUM") & ~F.col("p_name").endswith("bolt"))
    return rows.groupBy("p_type").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT c_custkey, c_nationkey, coalesce(len(l), 0) AS n FROM customer LEFT JOIN (
  SELECT o_custkey, list(o_orderkey) AS l FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey)
SELECT c_nationkey, count(*) FILTER (WHERE n = 0) AS empty, count(*) FILTER (WHERE n >= 3) AS three, CAST(max(n) AS BIGINT) AS most FROM a GROUP BY ALL""")
def array_emptiness(spark, sf_dir):
    """Empty, absent and long arrays told apart."""
    lists = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list("o_orderkey").alias("l"))
    n = F.size(F.coalesce("l", F.array().cast("array<bigint>")))
    rows = table(spark, sf_dir, "customer").join(lists, "c_custkey", "left").withColumn("n", n)
    return rows.groupBy("c_nationkey").agg(
        F.count_if(F.col("n") == 0).alias("empty"), F.count_if(F.col("n") >= 3).alias("three"), F.max("n").cast("long").alias("most")
    )


@query("""
WITH pt AS (SELECT p_name, p_brand, min(p_partkey) AS preferred FROM part WHERE p_size <= 10 GROUP BY ALL)
SELECT p_partkey, preferred FROM part JOIN pt USING (p_name, p_brand) WHERE p_size > 10""")
def preferred_terms(spark, sf_dir):
    """Synonyms joined to the preferred term of their concept; one preferred term a concept, so no fan-out."""
    parts = table(spark, sf_dir, "part")
    preferred = parts.filter("p_size <= 10").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("preferred"))
    return parts.filter("p_size > 10").join(preferred, ["p_name", "p_brand"]).select("p_partkey", "preferred")


@query("""
SELECT DISTINCT s_suppkey, c_custkey FROM supplier JOIN customer ON s_suppkey = c_custkey OR round(s_acctbal, 0) = round(c_acctbal, 0)
  OR right(s_name, 4) = right(c_name, 4)""")
def any_key_join(spark, sf_dir):
    """Pairs that agree in one of three keys."""
    keys = [
        (F.col("s_suppkey").cast("string"), F.col("c_custkey").cast("string")),
        (F.round("s_acctbal", 0).cast("string"), F.round("c_acctbal", 0).cast("string")),
        (F.right("s_name", F.lit(4)), F.right("c_name", F.lit(4))),
    ]
    return resolve.any_key_join(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer"), keys, ["s_suppkey", "c_custkey"])


@query("""
WITH t AS (SELECT DISTINCT lower(string_split(text, ' ')[1]) AS term FROM benchmark WHERE length(string_split(text, ' ')[1]) >= 5),
h AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY length(term) DESC, term) AS r FROM documents JOIN t ON contains(lower(text), term))
SELECT term, count(*) AS docs FROM h WHERE r = 1 GROUP BY term""")
def containing_terms(spark, sf_dir):
    """The longest term that each text holds as a substring."""
    word = F.lower(F.split("text", " ")[0])
    terms = table(spark, sf_dir, "benchmark").select(word.alias("term")).filter("length(term) >= 5").distinct()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return resolve.containing(docs, terms, "text", "term", "doc_id").groupBy("term").agg(F.count("*").alias("docs"))


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
SELECT c_nationkey, string_agg(c_mktsegment || '=' || n, ',' ORDER BY c_mktsegment) AS entries FROM c GROUP BY c_nationkey""")
def map_aggregate(spark, sf_dir):
    """A map of counts for each key, written out in the order of its keys."""
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    maps = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("m"))
    entries = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return maps.select("c_nationkey", F.array_join(entries, ",").alias("entries"))


@query("""
SELECT c_nationkey, count(*) AS customers FROM customer JOIN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 3)
  ON o_custkey = c_custkey GROUP BY c_nationkey""")
def complete_groups(spark, sf_dir):
    """Groups that hold all three values of a type, by the size of the collected set."""
    sets = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set("o_orderstatus").alias("s"))
    full = sets.filter("size(s) = 3").select("c_custkey")
    return table(spark, sf_dir, "customer").join(full, "c_custkey").groupBy("c_nationkey").agg(F.count("*").alias("customers"))


@query("""
SELECT word, count(DISTINCT p_type) AS types, count(*) AS parts FROM (SELECT p_type, unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word HAVING count(DISTINCT p_type) > 1""")
def group_conflicts(spark, sf_dir):
    """Synonym groups that map to more than one id."""
    words = table(spark, sf_dir, "part").select("p_type", F.explode(F.split("p_name", " ")).alias("word"))
    grouped = words.groupBy("word").agg(F.countDistinct("p_type").alias("types"), F.count("*").alias("parts"))
    return grouped.filter("types > 1")


@query("""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
  count(DISTINCT l_orderkey) AS orders, round(sum(l_extendedprice), 2) AS price FROM lineitem""")
def stage_counters(spark, sf_dir):
    """The counters of a stage as one aggregate."""
    return table(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.countDistinct("l_orderkey").alias("orders"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
    )


@query("SELECT o_orderkey FROM orders WHERE substr(md5('sample:' || o_orderkey), 1, 2) < '05'")
def bernoulli_sample(spark, sf_dir):
    """A repeatable sample of 5 in 256 rows, drawn by a keyed hash (the feature: a sample)."""
    draw = F.substring(F.md5(F.concat(F.lit("sample:"), F.col("o_orderkey").cast("string"))), 1, 2)
    return table(spark, sf_dir, "orders").filter(draw < "05").select("o_orderkey")


@query("SELECT c_custkey FROM customer ORDER BY md5('order:' || c_custkey) LIMIT 50")
def random_order(spark, sf_dir):
    """The first fifty rows of a seeded random order (the feature: a draw)."""
    draw = F.md5(F.concat(F.lit("order:"), F.col("c_custkey").cast("string")))
    return table(spark, sf_dir, "customer").select("c_custkey").orderBy(draw).limit(50)


_FORM = {"ring": "ring", "gear": "toothed gear"}


@query(r"""
WITH f AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' Tablet' WHEN 1 THEN p_name || ', Toothed  Gears' WHEN 2 THEN p_name ELSE p_name || ' ring' END AS name,
  CASE p_partkey % 4 WHEN 0 THEN 'tablet' WHEN 1 THEN 'gear' ELSE 'ring' END AS form FROM part)
SELECT p_partkey, CASE WHEN ends_with(lower(name), ' ' || form) THEN rtrim(name[1:length(name) - length(form) - 1])
  WHEN form = 'ring' THEN regexp_replace(name, '(?i)[\s,]+(?:ring)s?\s*$', '')
  WHEN form = 'gear' THEN regexp_replace(name, '(?i)[\s,]+(?:toothed[\s,/-]+gear)s?\s*$', '') ELSE name END AS name FROM f""")
def strip_form(spark, sf_dir):
    """Names without their form: exact endings, then patterns compiled from suffixes."""
    which, name = F.col("p_partkey") % 4, F.col("p_name")
    spoilt = F.when(which == 0, F.concat(name, F.lit(" Tablet"))).when(which == 1, F.concat(name, F.lit(", Toothed  Gears")))
    spoilt = spoilt.when(which == 2, name).otherwise(F.concat(name, F.lit(" ring")))
    form = F.when(which == 0, "tablet").when(which == 1, "gear").otherwise("ring")
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_form(spoilt, form, _FORM).alias("name"))


@query(r"""
WITH v AS (SELECT p_partkey, p_name, p_name || ' ' || (p_size % 3) || chr(97 + p_size % 2) AS full_name FROM part)
SELECT p_name, regexp_extract(replace(full_name, ' ', ''), '(\d[a-z])$', 1) AS variant, count(*) AS n FROM v GROUP BY ALL""")
def variant_guard(spark, sf_dir):
    """Names that differ in a variant suffix only are kept apart."""
    full = F.concat("p_name", F.lit(" "), (F.col("p_size") % 3).cast("string"), F.char(97 + F.col("p_size") % 2))
    return table(spark, sf_dir, "part").groupBy("p_name", text.variant_suffix(full).alias("variant")).agg(F.count("*").alias("n"))


@query(r"""
SELECT p_partkey, nullif(regexp_extract(x, '\(([^)]+)\)', 1), '') AS inner_name, len(list_filter(regexp_split_to_array(x, '[\s\-/]+'), lambda t: length(t) >= 6)) AS tokens
FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ' (' || p_brand || '/' || p_type || ')' ELSE p_name || '-' || p_type END AS x FROM part)""")
def parenthetical_tokens(spark, sf_dir):
    """What stands in parentheses, and the long tokens."""
    even = F.concat("p_name", F.lit(" ("), "p_brand", F.lit("/"), "p_type", F.lit(")"))
    x = F.when(F.col("p_size") % 2 == 0, even).otherwise(F.concat_ws("-", "p_name", "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", text.parenthetical(x).alias("inner_name"), F.size(text.long_tokens(x)).cast("long").alias("tokens"))


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest(CASE WHEN p_partkey % 3 = 2 THEN [p_name] ELSE string_split(p_name, ' ') END) AS word FROM part) GROUP BY word""")
def list_literals(spark, sf_dir):
    """Lists written as JSON, with single quotes, or as one plain value."""
    word, which = F.split("p_name", " "), F.col("p_partkey") % 3
    literal = F.when(which == 0, F.to_json(word)).when(which == 1, F.concat(F.lit("['"), F.array_join(word, "', '"), F.lit("']"))).otherwise(F.col("p_name"))
    words = table(spark, sf_dir, "part").select(F.explode(text.list_literal(literal)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(r"""
SELECT variant, count(*) AS n FROM (SELECT unnest(list_distinct([p_name, regexp_replace(p_name, '(?i)[\s,]+(?:bolt)s?\s*$', ''), regexp_replace(p_name, '(?i)[\s,]+(?:gear)s?\s*$', '')])) AS variant FROM part) GROUP BY variant""")
def name_variants(spark, sf_dir):
    """Names with their suffix-free variants, each once."""
    variants = text.name_variants(F.col("p_name"), ["bolt", "gear"])
    return table(spark, sf_dir, "part").select(F.explode(variants).alias("variant")).groupBy("variant").agg(F.count("*").alias("n"))


@query("""
SELECT grade, count(*) AS n FROM (SELECT CASE WHEN a = b THEN 'GREEN' WHEN contains(a, b) OR contains(b, a) THEN 'YELLOW' ELSE 'RED' END AS grade FROM (
  SELECT lower(p_name) AS a, lower(CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN string_split(p_name, ' ')[2] ELSE p_type END) AS b FROM part)) GROUP BY grade""")
def match_grades(spark, sf_dir):
    """Grades of matches: equal, contained, neither."""
    which = F.col("p_partkey") % 3
    other = F.when(which == 0, F.upper("p_name")).when(which == 1, F.split("p_name", " ")[1]).otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").groupBy(text.grade(F.col("p_name"), other).alias("grade")).agg(F.count("*").alias("n"))


@query(r"""
WITH c AS (SELECT p_partkey, printf('%05d-%03d-%02d', CAST(p_partkey % 300 AS INTEGER), p_size, CAST(p_partkey % 7 AS INTEGER)) AS code FROM part)
SELECT regexp_extract(code, '^(\d+-\d+)-', 1) AS product, count(*) AS packages, count(*) FILTER (WHERE contains('3' || replace(code, '-', '') || '9', replace(regexp_extract(code, '^(\d+-\d+)-', 1), '-', ''))) AS in_upc
FROM c GROUP BY 1""")
def code_prefixes(spark, sf_dir):
    """Package codes to product codes, and product digits inside longer codes."""
    code = F.format_string("%05d-%03d-%02d", F.col("p_partkey") % 300, F.col("p_size"), F.col("p_partkey") % 7)
    rows = table(spark, sf_dir, "part").select(code.alias("code")).withColumn("product", F.substring_index("code", "-", 2))
    upc = F.concat(F.lit("3"), F.replace("code", F.lit("-"), F.lit("")), F.lit("9"))
    held = F.contains(upc, F.replace("product", F.lit("-"), F.lit("")))
    return rows.groupBy("product").agg(F.count("*").alias("packages"), F.count_if(held).alias("in_upc"))


@query(r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\b([A-Z][a-z]{4,}ing)\b', 1)) AS word FROM documents) GROUP BY word""")
def pattern_findall(spark, sf_dir):
    """All matches of a pattern, as rows."""
    found = F.regexp_extract_all("text", F.lit(r"\b([A-Z][a-z]{4,}ing)\b"), F.lit(1))
    return table(spark, sf_dir, "documents").select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("""
SELECT lang, count(*) AS n, CAST(sum(length(phrase)) AS BIGINT) AS chars FROM (
  SELECT lang, unnest(regexp_extract_all(text, 'the ([a-z ]{3,60}?) of ', 1)) AS phrase FROM documents) GROUP BY lang""")
def target_phrases(spark, sf_dir):
    """Shortest phrases between two marks."""
    found = F.regexp_extract_all("text", F.lit("the ([a-z ]{3,60}?) of "), F.lit(1))
    rows = table(spark, sf_dir, "documents").select("lang", F.explode(found).alias("phrase"))
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("phrase")).alias("chars"))


_ARROWS = "CASE l_linenumber % 3 WHEN 0 THEN '↑ ' WHEN 1 THEN '↓' ELSE '↔ ' END || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || CASE WHEN l_tax > 0.04 THEN '% (90% CI)' ELSE ' fold' END"


@query(rf"""
SELECT CASE substr(x, 1, 1) WHEN '↑' THEN 'up' WHEN '↓' THEN 'down' ELSE 'same' END AS direction, TRY_CAST(nullif(regexp_extract(x, '[↑↓↔]\s*(\d+)%', 1), '') AS INTEGER) AS pct, count(*) AS n
FROM (SELECT {_ARROWS} AS x FROM lineitem) GROUP BY ALL""")
def arrow_changes(spark, sf_dir):
    """Directions and percentages of changes written with arrows."""
    which = F.col("l_linenumber") % 3
    arrow = F.when(which == 0, "↑ ").when(which == 1, "↓").otherwise("↔ ")
    unit = F.when(F.col("l_tax") > 0.04, "% (90% CI)").otherwise(" fold")
    direction, pct = text.arrow_change(F.concat(arrow, F.col("l_quantity").cast("int").cast("string"), unit))
    return table(spark, sf_dir, "lineitem").groupBy(direction.alias("direction"), pct.alias("pct")).agg(F.count("*").alias("n"))


@query("""
SELECT CASE l_linenumber % 4 WHEN 0 THEN 'empty stomach' WHEN 1 THEN 'separate' WHEN 2 THEN 'with food' ELSE 'any' END AS timing, count(*) AS n FROM lineitem GROUP BY ALL""")
def timing_classes(spark, sf_dir):
    """Classes of administration times, by ordered rules."""
    which, hours = F.col("l_linenumber") % 4, F.col("l_quantity").cast("int").cast("string")
    said = (
        F.when(which == 0, "Take on an Empty Stomach").when(which == 1, F.concat(F.lit("Take "), hours, F.lit(" hours before meals")))
        .when(which == 2, "take with meals").otherwise("take daily")
    )
    return table(spark, sf_dir, "lineitem").groupBy(text.timing(said).alias("timing")).agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 5.0 WHEN 2 THEN 10.0 WHEN 3 THEN 25.0 ELSE 50.0 END::DOUBLE AS near FROM (
  SELECT p_partkey, p_size FROM part)""")
def nearest_strength(spark, sf_dir):
    """The nearest available strength, the lesser one of two."""
    dose = F.element_at(F.array(*[F.lit(x) for x in (2.9, 7.5, 12.0, 37.4, 80.0)]), (F.col("p_size") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.nearest(dose, [50.0, 1.0, 5.0, 10.0, 25.0]).alias("near"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 100 ELSE CAST(floor(100 * (1 - levenshtein(a, b) / CAST(greatest(length(a), length(b)) AS DOUBLE))) AS BIGINT) END AS ratio
FROM (SELECT p_partkey, array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') AS a, array_to_string(list_sort(string_split(lower(p_type || ' ' || string_split(p_name, ' ')[1]), ' ')), ' ') AS b FROM part)""")
def token_sort_ratios(spark, sf_dir):
    """Similarity of names up to the order of their words."""
    word = F.split("p_name", " ")
    other = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", F.reverse(word))).otherwise(F.concat_ws(" ", "p_type", word[0]))
    return table(spark, sf_dir, "part").select("p_partkey", text.token_sort_ratio(F.col("p_name"), other).alias("ratio"))


_CLAIMS = """
WITH s1 AS (SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey * 7 ORDER BY s_suppkey) AS n, s_suppkey * 7 AS k FROM supplier),
t1 AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_custkey ORDER BY c_custkey) AS n, c_custkey AS k FROM customer WHERE c_mktsegment <> 'BUILDING'),
p1 AS (SELECT s_suppkey, c_custkey FROM s1 JOIN t1 USING (k, n)),
s2 AS (SELECT s_suppkey, s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM p1)),
t2 AS (SELECT c_custkey, c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT c_custkey FROM p1))
SELECT *, 1 AS step FROM p1 UNION ALL SELECT s_suppkey, c_custkey, 2 FROM s2 JOIN t2 USING (k, n)"""


@query(_CLAIMS)
def claim_once(spark, sf_dir):
    """Sources matched to targets in two passes, each target claimed once."""
    targets = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    keys = [(F.col("s_suppkey") * 7, F.col("c_custkey")), (F.col("s_nationkey").cast("long"), F.col("c_nationkey").cast("long"))]
    return resolve.claim_once(table(spark, sf_dir, "supplier"), targets, keys, "s_suppkey", "c_custkey")


@query("""
WITH f AS (SELECT p_brand, min(p_partkey) AS id FROM part WHERE p_size < 5 GROUP BY p_brand), g AS (SELECT p_type, min(p_partkey) AS id FROM part GROUP BY p_type)
SELECT pass, count(*) AS n, count(id) AS mapped FROM (SELECT CASE WHEN f.id IS NOT NULL THEN 1 WHEN g.id IS NOT NULL THEN 2 ELSE 0 END AS pass, coalesce(f.id, g.id) AS id
  FROM part LEFT JOIN f ON f.p_brand = part.p_brand AND p_size >= 5 AND part.p_partkey % 3 > 0 LEFT JOIN g ON g.p_type = part.p_type AND part.p_partkey % 5 > 0) GROUP BY pass""")
def second_pass(spark, sf_dir):
    """A primary map, a second pass for what it leaves, and their coverage."""
    parts = table(spark, sf_dir, "part")
    brands = parts.filter("p_size < 5").groupBy("p_brand").agg(F.min("p_partkey").alias("id"))
    types = parts.groupBy("p_type").agg(F.min("p_partkey").alias("id"))
    primary = parts.filter("p_size >= 5 AND p_partkey % 3 > 0").join(brands, "p_brand").select("p_partkey", "id")
    fallback = parts.filter("p_partkey % 5 > 0").join(types, "p_type").select("p_partkey", "id")
    done = resolve.second_pass(parts.select("p_partkey"), primary, fallback, "p_partkey", "id")
    return done.groupBy("pass").agg(F.count("*").alias("n"), F.count("id").alias("mapped"))


@query("""
SELECT o_custkey, status, coalesce(c_name, 'new ' || o_custkey) AS name, coalesce(n_name, 'unknown') AS nation FROM (
  SELECT DISTINCT o_custkey + 1000000 * (o_orderkey % 2) AS o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'known' ELSE 'new' END AS status FROM orders)
LEFT JOIN customer ON c_custkey = o_custkey - CASE WHEN status = 'new' THEN 1000000 ELSE 0 END AND c_acctbal > 0 LEFT JOIN nation ON n_nationkey = c_nationkey
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def new_entities(spark, sf_dir):
    """Keys that no table knows, enriched by lookups with fallbacks."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    is_new = F.col("o_orderkey") % 2 == 1
    key = F.col("o_custkey") + F.when(is_new, 1_000_000).otherwise(0)
    seen = orders.select(key.alias("k"), F.when(is_new, "new").otherwise("known").alias("status")).distinct()
    fresh = seen.join(customers.select(F.col("c_custkey").alias("k")), "k", "left_anti")
    at = F.col("k") - F.when(F.col("status") == "new", 1_000_000).otherwise(0)
    named = fresh.withColumn("at", at).join(customers.filter("c_acctbal > 0"), F.col("at") == F.col("c_custkey"), "left")
    nations = table(spark, sf_dir, "nation")
    full = named.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    name = F.coalesce("c_name", F.concat(F.lit("new "), F.col("k").cast("string")))
    return full.select(F.col("k").alias("o_custkey"), "status", name.alias("name"), F.coalesce("n_name", F.lit("unknown")).alias("nation"))


@query("""
WITH g AS (SELECT user_id, max((ts, event_id)) AS good FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT user_id, count(*) AS attempts, max_by(value, (ts, event_id)) AS reason FROM events LEFT JOIN g USING (user_id)
WHERE event_type = 'error' AND (good IS NULL OR (ts, event_id) > good) GROUP BY user_id""")
def failure_queue(spark, sf_dir):
    """Failures since the last success of each key, with attempts and the latest reason."""
    kind = F.col("event_type")
    return resolve.failure_queue(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], kind == "error", kind == "purchase", "value")


@query("""
SELECT 'orders without customer' AS check_name, count(*) AS value, 0 AS expected, CASE WHEN count(*) = 0 THEN 'ok' ELSE 'fail' END AS status FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'repeated order keys', count(*), 0, CASE WHEN count(*) = 0 THEN 'ok' ELSE 'fail' END FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'negative balances', count(*), 0, CASE WHEN count(*) = 0 THEN 'ok' ELSE 'fail' END FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'lines without part', count(*), 0, CASE WHEN count(*) = 0 THEN 'ok' ELSE 'fail' END FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'brands', count(DISTINCT p_brand), 25, CASE WHEN count(DISTINCT p_brand) = 25 THEN 'ok' ELSE 'fail' END FROM part""")
def quality_report(spark, sf_dir):
    """A data-quality report: check, value, expected value, status."""
    orders, customers, parts = (table(spark, sf_dir, t) for t in ("orders", "customer", "part"))
    lines = table(spark, sf_dir, "lineitem")
    checks = [
        ("orders without customer", orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left_anti"), "*", 0),
        ("repeated order keys", orders.groupBy("o_orderkey").count().filter("count > 1"), "*", 0),
        ("negative balances", customers.filter("c_acctbal < 0"), "*", 0),
        ("lines without part", lines.join(parts, lines["l_partkey"] == parts["p_partkey"], "left_anti"), "*", 0),
        ("brands", parts.select("p_brand").distinct(), "*", 25),
    ]
    out = None
    for name, rows, what, expected in checks:
        row = rows.agg(F.count(what).alias("value")).select(F.lit(name).alias("check_name"), "value", F.lit(expected).alias("expected"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("status", F.when(F.col("value") == F.col("expected"), "ok").otherwise("fail"))


@query("""
SELECT n_name, s_suppkey, CAST(row_number() OVER (PARTITION BY n_name ORDER BY line, total DESC, s_suppkey) AS BIGINT) AS place FROM (
  SELECT n_name, s_suppkey, CASE WHEN avg(l_discount) < 0.05 THEN 1 ELSE 2 END AS line, CAST(sum(l_quantity) AS BIGINT) AS total
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL)""")
def ranked_candidates(spark, sf_dir):
    """Candidates of each condition, ranked by line and then by evidence."""
    from pyspark.sql import Window as W

    # A mean of 0.05 would depend on the order in which doubles are added. In units of 2**-60, doubles from 2**-8 to 8 are whole
    # numbers, so both sides are exact.
    units = F.sum((F.col("l_discount") * 2.0**60).cast("long").cast("decimal(38,0)"))
    line = F.when(units < F.count("l_discount").cast("decimal(19,0)") * F.lit(int(0.05 * 2.0**60)), 1).otherwise(2)
    per = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(line.alias("line"), F.sum("l_quantity").cast("long").alias("total"))
    named = per.join(table(spark, sf_dir, "supplier"), "s_suppkey").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    place = F.row_number().over(W.partitionBy("n_name").orderBy("line", F.desc("total"), "s_suppkey")).cast("long")
    return named.select("n_name", "s_suppkey", place.alias("place"))


_PAIRS = """
WITH i AS (SELECT DISTINCT l_orderkey, p_brand, p_type FROM lineitem JOIN part ON p_partkey = l_partkey),
q AS (SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n, count(*) FILTER (WHERE x.p_type = y.p_type) AS same_class FROM i x JOIN i y
  ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY ALL)"""


@query(_PAIRS + " SELECT a, b, n, same_class, CASE WHEN same_class > 0 THEN 'block' ELSE 'allow' END AS verdict FROM q")
def pairwise_check(spark, sf_dir):
    """Pairs of items inside each order (a few items), checked by class."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    items = lines.join(parts, "p_partkey").select("l_orderkey", "p_brand", "p_type").distinct()
    x, y = items.alias("x"), items.alias("y")
    pairs = x.join(y, F.expr("x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand"))
    grouped = pairs.groupBy(F.col("x.p_brand").alias("a"), F.col("y.p_brand").alias("b")).agg(
        F.count("*").alias("n"), F.count_if(F.expr("x.p_type = y.p_type")).alias("same_class")
    )
    return grouped.withColumn("verdict", F.when(F.col("same_class") > 0, "block").otherwise("allow"))


@query("""
WITH a AS (SELECT c_nationkey, c_mktsegment, round(avg(c_acctbal), 2) AS v FROM customer WHERE c_custkey % 3 = 0 GROUP BY ALL),
b AS (SELECT c_nationkey, round(avg(c_acctbal), 2) AS v FROM customer WHERE c_custkey % 7 = 0 GROUP BY ALL)
SELECT c_custkey, CASE WHEN a.v IS NOT NULL THEN 'exact' WHEN b.v IS NOT NULL THEN 'nation' ELSE 'default' END AS level, coalesce(a.v, b.v, 0.0::DOUBLE) AS v
FROM customer LEFT JOIN a USING (c_nationkey, c_mktsegment) LEFT JOIN b USING (c_nationkey)""")
def fallback_levels(spark, sf_dir):
    """A value from the most exact of three levels that has one."""
    rows = table(spark, sf_dir, "customer")
    mean = F.round(F.avg("c_acctbal"), 2)
    a = rows.filter("c_custkey % 3 = 0").groupBy("c_nationkey", "c_mktsegment").agg(mean.alias("a"))
    b = rows.filter("c_custkey % 7 = 0").groupBy("c_nationkey").agg(mean.alias("b"))
    level = F.when(F.col("a").isNotNull(), "exact").when(F.col("b").isNotNull(), "nation").otherwise("default")
    joined = rows.join(a, ["c_nationkey", "c_mktsegment"], "left").join(b, "c_nationkey", "left")
    return joined.select("c_custkey", level.alias("level"), F.coalesce("a", "b", F.lit(0.0)).alias("v"))


@query(_PAIRS + """, bad AS (SELECT a AS brand FROM q WHERE 100 * same_class >= 40 * n UNION SELECT b FROM q WHERE 100 * same_class >= 40 * n)
SELECT p_type, count(*) AS n FROM part WHERE p_brand NOT IN (SELECT brand FROM bad) GROUP BY p_type""")
def candidates_without_conflicts(spark, sf_dir):
    """Candidates less those of a severe conflict, by an anti join."""
    severe = pairwise_check(spark, sf_dir).filter("100 * same_class >= 40 * n")
    bad = severe.select(F.col("a").alias("p_brand")).unionByName(severe.select(F.col("b").alias("p_brand"))).distinct()
    return table(spark, sf_dir, "part").join(bad, "p_brand", "left_anti").groupBy("p_type").agg(F.count("*").alias("n"))


@query("""
SELECT event_type, CAST(epoch(w) AS BIGINT) AS start, count(*) AS n FROM (
  SELECT event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY ALL""")
def sliding_counts(spark, sf_dir):
    """Counts in windows of two hours that start each hour."""
    rows = table(spark, sf_dir, "events").groupBy(F.window("ts", "2 hours", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return rows.select("event_type", F.unix_timestamp("w.start").alias("start"), "n")


@query("""
SELECT lower(trim(p_name)) AS key, min(p_partkey) AS id, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1""")
def normalised_lookup(spark, sf_dir):
    """One row for each normalised name, as a lookup table holds it."""
    return table(spark, sf_dir, "part").groupBy(F.lower(F.trim("p_name")).alias("key")).agg(F.min("p_partkey").alias("id"), F.countDistinct("p_brand").alias("brands"))


@query("""
SELECT doc_id, regexp_matches(text, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AS has_number, length(text) < 200 AS too_short, regexp_matches(text, '[#%&*]{3,}') AS has_noise FROM documents""")
def post_checks(spark, sf_dir):
    """Predicates that an answer must pass, as patterns."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.rlike("text", F.lit("[0-9]{3}-[0-9]{2}-[0-9]{4}")).alias("has_number"),
        (F.length("text") < 200).alias("too_short"),
        F.rlike("text", F.lit("[#%&*]{3,}")).alias("has_noise"),
    )


@query("""
WITH c AS (SELECT p_name, min(p_partkey) AS first_key, list(DISTINCT p_brand ORDER BY p_brand) AS brands FROM part GROUP BY p_name)
SELECT s.p_partkey, unnest(c.brands) AS synonym, c.first_key = s.p_partkey AS is_first FROM part s JOIN c USING (p_name) WHERE s.p_size > 25""")
def attach_synonyms(spark, sf_dir):
    """Synonyms of a concept attached to each of its rows that has none of its own."""
    parts = table(spark, sf_dir, "part")
    literal = F.to_json(F.array_sort(F.collect_set("p_brand")))
    concepts = parts.groupBy("p_name").agg(F.min("p_partkey").alias("first_key"), literal.alias("literal"))
    wanted = parts.filter("p_size > 25").select("p_partkey", "p_name")
    named = wanted.join(concepts, "p_name").select("p_partkey", "first_key", F.explode(text.list_literal(F.col("literal"))).alias("synonym"))
    return named.select("p_partkey", "synonym", (F.col("first_key") == F.col("p_partkey")).alias("is_first"))


@query("""
WITH w AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) || '  ' WHEN 2 THEN replace(p_name, ' ', 'x ') ELSE 'qqqq' END AS name
  FROM customer JOIN part ON p_partkey = c_custkey),
n AS (SELECT p_name, min(p_partkey) AS id FROM part GROUP BY p_name),
g AS (SELECT name, list_distinct(flatten(list_transform(string_split(lower(name), ' '), lambda w: list_transform(range(1, CAST(length(w) AS BIGINT) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS t FROM (
  SELECT DISTINCT lower(trim(name)) AS name FROM w UNION SELECT p_name FROM n)),
s AS (SELECT x.name AS k, y.name AS p_name, len(list_intersect(x.t, y.t)) / CAST(len(list_distinct(x.t || y.t)) AS DOUBLE) AS sim FROM g x, g y
  WHERE x.name IN (SELECT lower(trim(name)) FROM w) AND y.name IN (SELECT p_name FROM n)),
b AS (SELECT k, p_name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(sim, 9) DESC, p_name) AS r FROM s WHERE sim >= 0.5) WHERE r = 1)
SELECT c_custkey, CASE WHEN e.id IS NOT NULL THEN 1 WHEN l.id IS NOT NULL THEN 2 WHEN t.id IS NOT NULL THEN 3 END AS step, coalesce(e.id, l.id, t.id) AS id
FROM w LEFT JOIN n e ON e.p_name = name LEFT JOIN n l ON l.p_name = lower(trim(name)) LEFT JOIN b ON b.k = lower(trim(name)) LEFT JOIN n t ON t.p_name = b.p_name""")
def brand_waterfall(spark, sf_dir):
    """Exact, normalised, then trigram matches; only names that a step leaves go to the next one."""
    from tessera.operators import similarity

    parts = table(spark, sf_dir, "part")
    which, name = F.col("c_custkey") % 4, F.col("p_name")
    spoilt = F.when(which == 0, name).when(which == 1, F.concat(F.upper(name), F.lit("  "))).when(which == 2, F.replace(name, F.lit(" "), F.lit("x "))).otherwise("qqqq")
    wanted = table(spark, sf_dir, "customer").join(parts, F.col("p_partkey") == F.col("c_custkey")).select("c_custkey", spoilt.alias("name"))
    known = parts.groupBy("p_name").agg(F.min("p_partkey").alias("id"))
    names = wanted.select("name", F.lower(F.trim("name")).alias("k")).distinct()
    exact = names.join(known, F.col("name") == F.col("p_name")).select("name", F.lit(1).alias("step"), "id")
    rest = names.join(exact, "name", "left_anti")
    folded = rest.join(known, F.col("k") == F.col("p_name")).select("name", F.lit(2).alias("step"), "id")
    rest = rest.join(folded, "name", "left_anti")
    pairs = similarity.trigram_join(rest, known, "k", "p_name", 0.5).withColumn("similarity", F.round("similarity", 9))
    best = rank.first_of(pairs, ["a"], [F.desc("similarity"), F.col("b")])
    near = rest.join(best, F.col("k") == F.col("a")).join(known, F.col("b") == F.col("p_name")).select("name", F.lit(3).alias("step"), "id")
    found = exact.unionByName(folded).unionByName(near)
    return wanted.join(found, "name", "left").select("c_custkey", "step", "id")
