"""Entity resolution: the resolver and its table functions, dedup of skeletons by levels, claims of targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import resolve, resolver
from tessera.plans.base import query
from tessera.session import stage
from tessera.sources.tables import table

_SALT = "|".join(s.replace(" ", r"\s+") for s in text.SALTS)

#: Brands, ingredients, entities, synonyms, and customers' spellings of names, spoilt in eight ways.
_RELATIONS = rf"""
WITH brands AS (SELECT p_brand AS brand_id, p_brand AS brand, CASE WHEN count(*) % 2 = 0 THEN min(p_partkey) END AS id FROM part GROUP BY p_brand),
ingredients AS (SELECT p_brand AS brand_id, p_partkey AS id FROM part WHERE p_size <= 5),
entities AS (SELECT min(p_partkey) AS id, p_name AS name, list_distinct(list(p_type || ' ' || p_size) FILTER (WHERE p_size > 45)) AS other_names, upper(p_name) AS plain_name FROM part GROUP BY p_name),
synonyms AS (SELECT DISTINCT 'syn ' || array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS synonym, p_partkey AS id FROM part WHERE p_size BETWEEN 20 AND 22),
wanted AS (SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN lower(p_brand) WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || ' sodium' WHEN 3 THEN substr(p_name, 1, 3) || substr(p_name, 5)
  WHEN 4 THEN lower(p_type || ' ' || p_size) WHEN 5 THEN p_brand || 'x' WHEN 6 THEN 'SYN ' || array_to_string(list_reverse(string_split(p_name, ' ')), ' ') ELSE 'zzz ' || p_size END AS name
  FROM customer JOIN part ON p_partkey = c_custkey),
names AS (SELECT DISTINCT name, upper(name) AS up FROM wanted),
grams AS (SELECT x, list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower(x), '[^a-z0-9]+'), lambda w: w <> ''),
  lambda w: list_transform(range(1, CAST(length(w) AS BIGINT) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS t
  FROM (SELECT name AS x FROM names UNION SELECT brand FROM brands UNION SELECT name FROM entities UNION SELECT synonym FROM synonyms UNION SELECT unnest(other_names) FROM entities)),
alike AS (SELECT n.x AS name, k.x AS known, len(list_intersect(n.t, k.t)) / CAST(len(list_distinct(n.t || k.t)) AS DOUBLE) AS s FROM grams n SEMI JOIN names ON n.x = names.name JOIN grams k ON len(list_intersect(n.t, k.t)) > 0),
f_brand AS (SELECT DISTINCT name, id, brand AS matched, s FROM alike JOIN brands ON known = brand WHERE id IS NOT NULL AND s > 0.6),
f_entity AS (SELECT DISTINCT a.name, id, e.name AS matched, s FROM alike a JOIN entities e ON known = e.name WHERE s > 0.5),
f_synonym AS (SELECT DISTINCT name, id, synonym AS matched, s FROM alike JOIN synonyms ON known = synonym WHERE s > 0.5),
f_any AS (SELECT DISTINCT a.name, id, known AS matched, s FROM alike a JOIN (SELECT id, name AS k FROM entities UNION SELECT id, unnest(other_names) FROM entities UNION SELECT id, synonym FROM synonyms) ON known = k WHERE s > 0.6),
t_brand AS (SELECT name, id, brand AS matched FROM names JOIN brands ON upper(brand) = up WHERE id IS NOT NULL),
t_combination AS (SELECT name, i.id, brand AS matched FROM names JOIN brands b ON upper(brand) = up JOIN ingredients i USING (brand_id)),
t_entity AS (SELECT DISTINCT n.name, id, e.name AS matched FROM names n JOIN entities e ON upper(e.name) = up OR list_contains(list_transform(other_names, lambda x: upper(x)), up)),
t_plain AS (SELECT n.name, id, e.name AS matched FROM names n JOIN entities e ON plain_name = upper(regexp_replace(n.name, '\s+({_SALT})\s*$', '', 'i'))),
t_synonym AS (SELECT DISTINCT name, id, synonym AS matched FROM names JOIN synonyms ON upper(synonym) = up)"""


def _resolved(*tiers: tuple[str, str]) -> str:
    parts = []
    for step, (label, rows) in enumerate(tiers, 1):
        top = f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY name ORDER BY s DESC, matched, id) <= 3)" if rows.startswith("f_") else rows
        parts.append(f"SELECT name, {step} AS step, '{label}' AS match_type, id, matched FROM {top}")
    union = " UNION ALL ".join(parts)
    return f"{_RELATIONS}, found AS (SELECT * FROM ({union}) QUALIFY step = min(step) OVER (PARTITION BY name))"


_FIRST = (("brand_exact", "t_brand"), ("combination", "t_combination"), ("entity", "t_entity"), ("plain_entity", "t_plain"))
_FUZZY = (("fuzzy_brand", "f_brand"), ("fuzzy_entity", "f_entity"))
_SIX = _resolved(*_FIRST, *_FUZZY)
_EIGHT = _resolved(*_FIRST, ("synonym", "t_synonym"), *_FUZZY, ("fuzzy_synonym", "f_synonym"))
_QUESTIONS = _resolved(("entity", "t_entity"), ("synonym", "t_synonym"), ("fuzzy_any", "f_any"))


def _reversed(name):
    return F.array_join(F.reverse(F.split(name, " ")), " ")


def _relations(spark, sf_dir) -> resolver.Relations:
    part = table(spark, sf_dir, "part")
    brands = part.groupBy(F.col("p_brand").alias("brand_id")).agg(F.when(F.count("*") % 2 == 0, F.min("p_partkey")).alias("id")).withColumn("brand", F.col("brand_id"))
    typed = F.when(F.col("p_size") > 45, F.concat_ws(" ", "p_type", F.col("p_size").cast("string")))
    entities = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"), F.collect_set(typed).alias("other_names"))
    synonyms = part.filter("p_size BETWEEN 20 AND 22").select(F.concat(F.lit("syn "), _reversed("p_name")).alias("synonym"), F.col("p_partkey").alias("id"))
    return resolver.Relations(
        stage(brands),
        part.filter("p_size <= 5").select(F.col("p_brand").alias("brand_id"), F.col("p_partkey").alias("id")),
        stage(entities.withColumn("plain_name", F.upper("name"))),
        stage(synonyms.distinct()),
    )


def _wanted(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("c_custkey"))
    spoilt = [
        F.lower("p_brand"), F.upper("p_name"), F.concat("p_name", F.lit(" sodium")), F.concat(F.left("p_name", F.lit(3)), F.substring("p_name", 5, 1 << 30)),
        F.lower(F.concat_ws(" ", "p_type", F.col("p_size").cast("string"))), F.concat("p_brand", F.lit("x")), F.concat(F.lit("SYN "), _reversed("p_name")),
        F.concat(F.lit("zzz "), F.col("p_size").cast("string")),
    ]
    which = F.col("c_custkey") % len(spoilt)
    return rows.select("c_custkey", reduce(lambda x, i: x.when(which == i, spoilt[i]), range(1, len(spoilt)), F.when(which == 0, spoilt[0])).alias("name"))


@query(_SIX + " SELECT * FROM found")
def resolve_six_tiers(spark, sf_dir):
    """Names resolved by the first of six tiers that knows them, with all its rows."""
    return resolver.resolve(_wanted(spark, sf_dir), _relations(spark, sf_dir))


@query(_EIGHT + " SELECT * FROM found")
def resolve_eight_tiers(spark, sf_dir):
    """The same with synonyms before the fuzzy tiers, and fuzzy synonyms last."""
    return resolver.resolve(_wanted(spark, sf_dir), _relations(spark, sf_dir), resolver.EIGHT)


@query(_QUESTIONS + " SELECT * FROM found")
def resolve_questions(spark, sf_dir):
    """The order for names in questions: names, synonyms, then whatever is similar enough."""
    return resolver.resolve(_wanted(spark, sf_dir), _relations(spark, sf_dir), resolver.QUESTIONS)


@query(_SIX + " SELECT c_custkey, name, step, match_type, id, matched FROM wanted LEFT JOIN found USING (name)")
def resolve_function(spark, sf_dir):
    """The resolver as a table function in SQL, for each row of a table."""
    wanted = _wanted(spark, sf_dir)
    return resolver.look_up(wanted, resolver.resolve(wanted, _relations(spark, sf_dir)))


@query(f"""
{_RELATIONS},
candidates AS (
  SELECT name, 1 AS step, 'entity' AS match_type, id, matched, 0 AS place FROM t_entity UNION ALL SELECT name, 2, 'plain_entity', id, matched, 0 FROM t_plain
  UNION ALL SELECT name, 3, 'combination', id, matched, 0 FROM t_combination)
SELECT name, step, match_type, id, matched FROM (SELECT *, rank() OVER (PARTITION BY name ORDER BY step) AS tier, row_number() OVER (PARTITION BY name ORDER BY step, id) AS n FROM candidates)
WHERE tier = 1 AND n <= 2""")
def first_tier_function(spark, sf_dir):
    """Candidates of all tiers at once, of which a registered table function keeps two rows of each name's first tier."""
    names, known = _wanted(spark, sf_dir).select("name").distinct().withColumn("up", F.upper("name")), _relations(spark, sf_dir)
    resolver.register(spark, spark.createDataFrame([], resolver.COLUMNS))
    rows = None
    for step, tier in enumerate((resolver.SIX[2], resolver.SIX[3], resolver.SIX[1]), 1):
        own = tier.find(names, known).select("name", F.lit(step).alias("step"), F.lit(tier.label).alias("match_type"), "id", "matched")
        rows = own if rows is None else rows.unionByName(own)
    return spark.sql("SELECT * FROM first_tier(TABLE(SELECT * FROM {rows}) PARTITION BY name ORDER BY (step, id), 2)", rows=rows)


_SKELETONS = """
WITH skeletons AS (SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'syn ' || p_name WHEN 2 THEN substr(p_name, 1, 4) || substr(p_name, 6) || 'e'
    WHEN 3 THEN substr(p_name, 1, length(p_name) - 3) || 'st' WHEN 4 THEN substr(p_name, 1, 5) || 'oo' ELSE 'qqqqqqqqqqqqqqqq' END AS name FROM customer JOIN part ON p_partkey = c_custkey),
targets AS (SELECT p_name AS name, min(p_partkey) AS id, CASE WHEN count(*) % 3 = 0 THEN min(p_brand) END AS taken FROM part GROUP BY p_name),
synonyms AS (SELECT 'syn ' || name AS synonym, min(id) AS id FROM targets WHERE id % 2 = 0 GROUP BY name),
s AS (SELECT id, name, lower(trim(name)) AS key, array_to_string(list_sort(string_split(lower(trim(name)), ' ')), ' ') AS sorted FROM skeletons),
t AS (SELECT id, name, taken, array_to_string(list_sort(string_split(lower(trim(name)), ' ')), ' ') AS sorted FROM targets),
exact AS (SELECT s.id, t.id AS target, 1 AS level, 100.0 AS score FROM s JOIN t ON s.key = lower(trim(t.name))),
syn AS (SELECT s.id, y.id AS target, 2 AS level, 100.0 AS score FROM s JOIN synonyms y ON s.key = lower(y.synonym) WHERE s.id NOT IN (SELECT id FROM exact)),
pairs AS (SELECT s.id, t.id AS target, 100 * (1 - levenshtein(s.sorted, t.sorted) / CAST(greatest(length(s.sorted), length(t.sorted)) AS DOUBLE)) AS score FROM s, t
  WHERE s.id NOT IN (SELECT id FROM exact UNION SELECT id FROM syn)),
fuzzy AS (SELECT * FROM pairs WHERE score >= 60 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, target) = 1),
found AS (SELECT * FROM exact UNION ALL SELECT * FROM syn UNION ALL SELECT id, target, CASE WHEN score >= 90 THEN 3 WHEN score >= 75 THEN 4 ELSE 5 END, score FROM fuzzy),
levels AS (SELECT s.id, s.name, coalesce(level, 0) AS level, CASE coalesce(level, 0) WHEN 0 THEN 'none' WHEN 1 THEN 'exact' WHEN 2 THEN 'synonym' WHEN 3 THEN 'high' WHEN 4 THEN 'medium' ELSE 'low' END AS category,
  round(score, 6) AS score, target FROM s LEFT JOIN found USING (id))"""


def _levels(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("c_custkey"))
    n, name = F.length("p_name"), F.col("p_name")
    spoilt = [
        F.upper(name), F.concat(F.lit("syn "), name), F.concat(F.left(name, F.lit(4)), F.substring(name, 6, 1 << 30), F.lit("e")),
        F.concat(F.substring(name, F.lit(1), n - 3), F.lit("st")), F.concat(F.left(name, F.lit(5)), F.lit("oo")),
    ]
    which = F.col("c_custkey") % 6
    skeletons = rows.select(F.col("c_custkey").alias("id"), reduce(lambda x, i: x.when(which == i, spoilt[i]), range(1, 5), F.when(which == 0, spoilt[0])).otherwise("q" * 16).alias("name"))
    targets = table(spark, sf_dir, "part").groupBy(name.alias("name")).agg(F.min("p_partkey").alias("id"), F.when(F.count("*") % 3 == 0, F.min("p_brand")).alias("taken"))
    targets = stage(targets)
    synonyms = targets.filter("id % 2 = 0").select(F.concat(F.lit("syn "), "name").alias("synonym"), "id")
    return resolve.dedup_levels(skeletons, targets, synonyms), targets


@query(_SKELETONS + " SELECT * FROM levels")
def skeleton_levels(spark, sf_dir):
    """Bare names matched to full entries by levels: exact, synonym, and edit ratios of 90, 75 and 60."""
    return _levels(spark, sf_dir)[0]


@query(_SKELETONS + " SELECT l.id, target, level FROM levels l JOIN targets t ON t.id = target WHERE level BETWEEN 1 AND 3 AND taken IS NULL AND lower(l.name) NOT IN ('red bolt', 'small ring')")
def skeleton_apply(spark, sf_dir):
    """The matches that are applied: the first three levels, without excluded names and targets that have an identifier."""
    levels, targets = _levels(spark, sf_dir)
    return resolve.applicable(levels, targets, ["red bolt", "small ring"])


_CLAIMS = """
WITH RECURSIVE sources AS (SELECT c_custkey AS source, CASE c_custkey % 4 WHEN 1 THEN left(p_name, 6) WHEN 3 THEN left(array_to_string(list_reverse(string_split(p_name, ' ')), ' '), CASE WHEN c_custkey % 8 = 3 THEN 7 ELSE 99 END) ELSE upper(p_name) END AS name, 'v' || (c_custkey % 3) AS value
  FROM customer JOIN part ON p_partkey = c_custkey WHERE c_custkey % 3 < 2),
targets AS (SELECT p_partkey AS target, p_name AS name, CASE WHEN p_partkey % 4 < 3 THEN 'v' || (p_partkey % 4) END AS value FROM part WHERE p_size > 40),
synonyms AS (SELECT p_partkey AS target, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS name FROM part WHERE p_size > 40),
hits AS (
  SELECT source, target, 1 AS step, lower(t.name) AS matched FROM sources s JOIN targets t ON lower(s.name) = lower(t.name)
  UNION ALL SELECT source, target, 2, lower(t.name) FROM sources s JOIN targets t ON starts_with(lower(t.name), lower(s.name)) AND lower(t.name) <> lower(s.name)
  UNION ALL SELECT source, target, 3, lower(t.name) FROM sources s JOIN synonyms t ON lower(s.name) = lower(t.name)
  UNION ALL SELECT source, target, 4, lower(t.name) FROM sources s JOIN synonyms t ON starts_with(lower(t.name), lower(s.name)) AND lower(t.name) <> lower(s.name)),
ranked AS (
  SELECT h.source, h.target, step, s.value IS NOT DISTINCT FROM t.value AS keeps, t.value AS old, row_number() OVER (PARTITION BY h.source ORDER BY step, matched, h.target) AS r
  FROM (SELECT source, target, b.step AS step, b.matched AS matched FROM (SELECT source, target, min({'step': step, 'matched': matched}) AS b FROM hits GROUP BY source, target)) h JOIN sources s USING (source) JOIN targets t USING (target)),
lists AS MATERIALIZED (SELECT source, list({'target': target, 'step': step, 'keeps': keeps, 'old': old} ORDER BY r) AS wants, row_number() OVER (ORDER BY source) AS turn FROM ranked GROUP BY source),
-- The sources in order, each with the best candidate that none before it has taken away.
run AS (
  SELECT CAST(0 AS BIGINT) AS turn, CAST([] AS BIGINT[]) AS gone, CAST(NULL AS BIGINT) AS source, NULL::STRUCT(target BIGINT, step INTEGER, keeps BOOLEAN, old VARCHAR) AS got
  UNION ALL
  SELECT l.turn, CASE WHEN g IS NULL OR g.keeps THEN run.gone ELSE list_append(run.gone, g.target) END, l.source, g
  FROM run JOIN lists l ON l.turn = run.turn + 1, LATERAL (SELECT list_filter(l.wants, lambda w: NOT list_contains(run.gone, w.target))[1] AS g))
SELECT s.source, got.target AS target, got.step AS step,
  CASE WHEN got IS NULL THEN 'inserted' WHEN got.keeps THEN 'already_correct' WHEN got.old IS NULL THEN 'filled' ELSE 'changed' END AS action
FROM sources s LEFT JOIN run USING (source)"""


@query(_CLAIMS)
def claims_with_inserts(spark, sf_dir):
    """Source values written to targets: by equal names, begun names, equal and begun synonyms; a changed target is taken
    once, an equal one stays free, and sources without a target become new rows."""
    part = table(spark, sf_dir, "part")
    rows = table(spark, sf_dir, "customer").filter("c_custkey % 3 < 2").join(part, F.col("p_partkey") == F.col("c_custkey"))
    which = F.col("c_custkey") % 8
    name = F.when(which % 4 == 1, F.left("p_name", F.lit(6))).when(which == 3, F.left(_reversed("p_name"), F.lit(7))).when(which == 7, _reversed("p_name")).otherwise(F.upper("p_name"))
    sources = rows.select(F.col("c_custkey").alias("source"), name.alias("name"), F.concat(F.lit("v"), (F.col("c_custkey") % 3).cast("string")).alias("value"))
    known = part.filter("p_size > 40")
    old = F.when(F.col("p_partkey") % 4 < 3, F.concat(F.lit("v"), (F.col("p_partkey") % 4).cast("string")))
    targets = known.select(F.col("p_partkey").alias("target"), F.col("p_name").alias("name"), old.alias("value"))
    synonyms = known.select(F.col("p_partkey").alias("target"), _reversed("p_name").alias("name"))
    return resolve.update_by_name(sources, targets, synonyms)


_BRANDS = rf"""
WITH lookup AS (SELECT DISTINCT p_partkey AS id, regexp_replace(upper(trim(p_name)), '\s+({_SALT})\s*$', '', 'i') AS plain, unnest([p_type, p_type || ' XR']) AS route, p_size AS strength FROM part WHERE p_size <= 45),
brands AS (SELECT c_custkey AS brand, regexp_replace(upper(trim(CASE c_custkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' sodium' WHEN 2 THEN p_name WHEN 3 THEN substr(p_name, 1, 4) || substr(p_name, 6) ELSE 'zz' END)), '\s+({_SALT})\s*$', '', 'i') AS plain,
  CASE WHEN c_custkey % 3 = 0 THEN p_type || ' XR' ELSE p_type END AS route, CASE WHEN c_custkey % 5 = 2 THEN 99 ELSE p_size END AS strength FROM customer JOIN part ON p_partkey = c_custkey),
grams AS (SELECT x, list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower(x), '[^a-z0-9]+'), lambda w: w <> ''),
  lambda w: list_transform(range(1, CAST(length(w) AS BIGINT) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS t FROM (SELECT plain AS x FROM brands UNION SELECT plain FROM lookup)),
alike AS (SELECT n.x AS plain, k.x AS known, len(list_intersect(n.t, k.t)) / CAST(len(list_distinct(n.t || k.t)) AS DOUBLE) AS s FROM grams n, grams k),
found AS (
  SELECT brand, 'exact' AS confidence, 1 AS step, 1.0 AS s, l.plain, id FROM brands b JOIN lookup l USING (plain, route, strength)
  UNION ALL SELECT brand, 'normalised', 2, 1.0, l.plain, id FROM brands b JOIN lookup l USING (plain, route)
  UNION ALL SELECT brand, 'fuzzy', 3, s, l.plain, id FROM brands b JOIN alike a ON a.plain = b.plain AND s > 0.7 JOIN lookup l ON l.plain = a.known AND l.route = b.route),
best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY brand ORDER BY step, s DESC, plain, id) = 1)"""


def _brand_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    routes = F.explode(F.array(F.col("p_type"), F.concat("p_type", F.lit(" XR"))))
    plain = text.strip_suffix(F.col("p_name"), text.SALTS, plural=False)
    lookup = part.filter("p_size <= 45").select(F.col("p_partkey").alias("id"), plain.alias("plain"), routes.alias("route"), F.col("p_size").alias("strength")).distinct()
    rows = table(spark, sf_dir, "customer").join(part, F.col("p_partkey") == F.col("c_custkey"))
    which, name = F.col("c_custkey") % 5, F.col("p_name")
    spoilt = F.when(which.isin(0, 2), name).when(which == 1, F.concat(name, F.lit(" sodium"))).when(which == 3, F.concat(F.left(name, F.lit(4)), F.substring(name, 6, 1 << 30))).otherwise("zz")
    route = F.when(F.col("c_custkey") % 3 == 0, F.concat("p_type", F.lit(" XR"))).otherwise(F.col("p_type"))
    strength = F.when(which == 2, 99).otherwise(F.col("p_size"))
    return rows.select(F.col("c_custkey").alias("brand"), spoilt.alias("name"), route.alias("route"), strength.alias("strength")), lookup


@query(_BRANDS + " SELECT brand, confidence, id FROM best")
def brand_mapping(spark, sf_dir):
    """Brands mapped by plain name, strength and route, then without strength, then by similar names of the route."""
    return resolve.map_brands(*_brand_rows(spark, sf_dir))


@query(_BRANDS + " SELECT b.brand, b.plain, b.route, b.strength FROM brands b ANTI JOIN best USING (brand)")
def brand_unmatched(spark, sf_dir):
    """The report of brands that no step maps."""
    brands, lookup = _brand_rows(spark, sf_dir)
    mapped = resolve.map_brands(brands, lookup).select("brand")
    plain = text.strip_suffix(F.col("name"), text.SALTS, plural=False).alias("plain")
    return brands.join(mapped, "brand", "left_anti").select("brand", plain, "route", "strength")


@query("""
WITH approvals AS (SELECT p_partkey AS id, unnest(['adult', 'pediatric', 'geriatric']) AS population, CASE WHEN p_size % 3 = 0 THEN 'approved' WHEN p_size % 3 = 1 THEN 'benefit_risk' ELSE 'contraindicated' END AS status FROM part WHERE p_size > 10),
asked AS (SELECT c_custkey, p_name, ['adult', 'pediatric', 'pregnant'][c_custkey % 3 + 1] AS population FROM customer JOIN part ON p_partkey = c_custkey),
known AS (SELECT p_name, min(p_partkey) AS id FROM part GROUP BY p_name),
brands AS (SELECT p_name, min(p_brand) AS brand FROM part GROUP BY p_name)
SELECT c_custkey, asked.population, coalesce(status, 'unknown') AS status, CASE asked.population WHEN 'pediatric' THEN 'pediatric_use' WHEN 'pregnant' THEN 'use_in_pregnancy' ELSE 'use_in_specific_populations' END AS section,
  CASE WHEN status IN ('approved', 'benefit_risk') THEN brand END AS brand
FROM asked JOIN known USING (p_name) LEFT JOIN approvals USING (id, population) LEFT JOIN brands USING (p_name)""")
def population_approval(spark, sf_dir):
    """Approval of a resolved entity for a population, the section to read, and brands where it is approved."""
    part = table(spark, sf_dir, "part")
    status = F.when(F.col("p_size") % 3 == 0, "approved").when(F.col("p_size") % 3 == 1, "benefit_risk").otherwise("contraindicated")
    kinds = F.explode(F.array(*map(F.lit, ("adult", "pediatric", "geriatric"))))
    approvals = part.filter("p_size > 10").select(F.col("p_partkey").alias("id"), kinds.alias("population"), status.alias("status"))
    population = F.element_at(F.array(*map(F.lit, ("adult", "pediatric", "pregnant"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    asked = table(spark, sf_dir, "customer").join(part, F.col("p_partkey") == F.col("c_custkey")).select("c_custkey", "p_name", population.alias("population"))
    known = part.groupBy("p_name").agg(F.min("p_partkey").alias("id"), F.min("p_brand").alias("brand"))
    return resolve.approvals(asked.join(known, "p_name"), approvals)
