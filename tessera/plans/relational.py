"""Joins, aggregates, ranks and write semantics over the relational tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.jsonx import is_blank_text
from tessera.operators import batches, enrich, graph, merge, quantile, rank
from tessera.plans.base import query
from tessera.session import stage
from tessera.sources.tables import table


@query("""
WITH p AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT l_partkey, l_suppkey, n, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem JOIN p USING (l_partkey, l_suppkey) GROUP BY ALL""")
def one_to_one_map(spark, sf_dir):
    """Composite keys that are not unique, with what their rows hold, in one aggregate."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("quantity"))
    return sums.filter("n > 1")


@query("""
SELECT lang, count(*) AS n, count(l.doc_id) AS labelled, count(*) FILTER (WHERE toxic = 1) AS toxic,
       round(100.0::DOUBLE * count(l.doc_id) / count(*), 2) AS pct
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang""")
def coverage_filter_counts(spark, sf_dir):
    """Conditional counts and a guarded percentage over a left join."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", F.lit(1).alias("has"))
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")
    return joined.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.count("has").alias("labelled"),
        F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.round(F.try_divide(100.0 * F.count("has"), F.count("*")), 2).alias("pct"),
    )


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def orphans_anti(spark, sf_dir):
    """Customers without large orders, by an anti join."""
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query("""
SELECT c_nationkey, count(*) AS customers,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)) AS orphans
FROM customer GROUP BY c_nationkey""")
def orphans_filter_exists(spark, sf_dir):
    """The same orphans counted through a flag on a left join with distinct keys."""
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    seen = large.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(1))
    joined = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(seen, "c_custkey", "left")
    return joined.groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.count_if(F.col("has").isNull()).alias("orphans")
    )


@query("""
SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY l_returnflag""")
def semi_two_sided(spark, sf_dir):
    """Rows that pass a semi join on either side."""
    parts = table(spark, sf_dir, "part").filter("p_size > 40").select(F.col("p_partkey").alias("l_partkey"))
    supp = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    lines = table(spark, sf_dir, "lineitem").join(parts, "l_partkey", "left_semi").join(supp, "l_suppkey", "left_semi")
    return lines.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""
SELECT p_partkey FROM part WHERE p_partkey NOT IN
  (SELECT x FROM (SELECT CASE WHEN l_quantity > 48 THEN l_partkey END AS x FROM lineitem) WHERE x IS NOT NULL)""")
def null_safe_not_in(spark, sf_dir):
    """NOT IN a column with nulls."""
    lines = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_quantity") > 48, F.col("l_partkey")).alias("x"))
    return merge.not_in(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", lines, "x")


_PER_CUSTOMER = """
WITH g AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)"""


def _orders_per_customer(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return (
        table(spark, sf_dir, "customer").select("c_custkey").join(counts, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    )


@query(_PER_CUSTOMER + " SELECT n, count(*) AS customers FROM g GROUP BY n")
def group_size_hist(spark, sf_dir):
    """Histogram of group sizes, with empty groups."""
    return _orders_per_customer(spark, sf_dir).groupBy("n").agg(F.count("*").alias("customers"))


_GRAPH_HUBS = """
WITH h AS (SELECT p_partkey AS src, length(p_type) % 5 AS dst, 'kind' AS type FROM part WHERE p_size < 4
  UNION ALL SELECT p_partkey, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) % 5, 'brand' FROM part WHERE p_size < 4)"""


@query(_PER_CUSTOMER + """
SELECT min(n) AS least, max(n) AS most, round(avg(n), 4) AS mean, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS middle FROM g""")
def group_size_stats(spark, sf_dir):
    """Extremes, mean and median of group sizes, with empty groups."""
    sizes = stage(_orders_per_customer(spark, sf_dir))
    middle = F.lit(quantile.quantile(sizes, "n")).cast("double").alias("middle")
    return sizes.agg(F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 4).alias("mean")).select("*", middle)


@query("SELECT event_type, CAST(quantile_cont(value, 0.25) AS DOUBLE) AS lower, CAST(quantile_cont(value, 0.5) AS DOUBLE) AS middle, CAST(quantile_cont(value, 0.9) AS DOUBLE) AS upper FROM events GROUP BY event_type")
def exact_quantiles(spark, sf_dir):
    """Exact quantiles of the values of each event type, by selection."""
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    kinds = [r[0] for r in rows.select("event_type").distinct().orderBy("event_type").collect()]
    found = [(k, *[quantile.quantile(rows.filter(F.col("event_type").eqNullSafe(k)), "value", q) for q in (0.25, 0.5, 0.9)]) for k in kinds]
    return spark.createDataFrame(found, "event_type string, lower double, middle double, upper double")


@query("""
WITH b AS (SELECT o_orderkey, ntile(32) OVER (ORDER BY o_orderkey) AS batch FROM orders)
SELECT batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM b GROUP BY batch""")
def equal_batches(spark, sf_dir):
    """Batches of the whole table by key, of sizes that differ by one at most."""
    rows = batches.equal_batches(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 32)
    return rows.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query(_GRAPH_HUBS + " SELECT x.src AS a, y.src AS b, count(*) AS paths FROM h x JOIN h y ON x.dst = y.dst AND x.type = 'kind' AND y.type = 'brand' AND x.src <> y.src GROUP BY ALL")
def graph_hubs(spark, sf_dir):
    """Two hops over hubs: parts of a size below 4 that meet in a type by one edge and in a brand's number by another."""
    part = table(spark, sf_dir, "part").filter("p_size < 4")
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long") % 5
    edges = part.select(F.col("p_partkey").alias("src"), (F.length("p_type") % 5).cast("long").alias("dst"), F.lit("kind").alias("type"))
    edges = edges.unionByName(part.select(F.col("p_partkey").alias("src"), number.alias("dst"), F.lit("brand").alias("type")))
    return graph.two_hop(edges, "kind", "brand", ways=1000)


@query("SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS pct FROM events GROUP BY 1")
def pct_of_total(spark, sf_dir):
    """Share of the grand total."""
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("event_type", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))


@query("""
SELECT 'customer' AS name, count(*) AS n, CAST(sum(c_acctbal) AS DECIMAL(38, 2))::DOUBLE AS total FROM customer
UNION ALL SELECT 'supplier', count(*), CAST(sum(s_acctbal) AS DECIMAL(38, 2))::DOUBLE FROM supplier
UNION ALL SELECT 'part', count(*), CAST(sum(p_retailprice) AS DECIMAL(38, 2))::DOUBLE FROM part""")
def scalar_subq_report(spark, sf_dir):
    """Labelled totals of several tables, one row each."""
    out = None
    for name, column in (("customer", "c_acctbal"), ("supplier", "s_acctbal"), ("part", "p_retailprice")):
        row = table(spark, sf_dir, name).agg(
            F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(column).cast("decimal(38,2)").cast("double").alias("total")
        )
        out = row if out is None else out.unionByName(row)
    return out


_TASK_ROWS = 1 << 19


@query("""
WITH e AS (SELECT DISTINCT o_custkey AS a, l_suppkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT a, count(*) AS one_way FROM e WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.a = e.b AND f.b = e.a) GROUP BY a""")
def mirror_edges(spark, sf_dir):
    """Edges from customers to suppliers whose reverse is missing, counted by their source."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    # As many tasks as rows ask for, so that none sorts or holds more than about _TASK_ROWS of them.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lines.count() // _TASK_ROWS + 1)
    orders, lines = orders.select("o_orderkey", "o_custkey").repartition(parts, "o_orderkey"), lines.select("l_orderkey", "l_suppkey").repartition(parts, "l_orderkey")
    edges = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("a"), F.col("l_suppkey").alias("b"))
    return graph.mirror_gaps(edges, parts).groupBy("a").agg(F.count("*").alias("one_way"))


@query("""
SELECT n_nationkey, count(*) AS pairs, CAST(sum(c_acctbal + s_acctbal) AS DECIMAL(38, 0))::DOUBLE AS total
FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN supplier ON s_nationkey = n_nationkey
WHERE c_custkey <> s_suppkey GROUP BY n_nationkey""")
def pair_fanout(spark, sf_dir):
    """Members of both sides of an edge paired, self pairs left out; counted from per-side sums, without the pairs."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    left = c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("nc"), F.sum("c_acctbal").alias("sc"))
    right = s.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("ns"), F.sum("s_acctbal").alias("ss"))
    same = (
        c.join(s, (F.col("c_custkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .groupBy(F.col("c_nationkey").alias("k"))
        .agg(F.count("*").alias("n0"), F.sum(F.col("c_acctbal") + F.col("s_acctbal")).alias("s0"))
    )
    total = F.col("sc") * F.col("ns") + F.col("ss") * F.col("nc") - F.coalesce("s0", F.lit(0.0))
    return (
        left.join(right, "k").join(same, "k", "left")
        .select(F.col("k").alias("n_nationkey"), (F.col("nc") * F.col("ns") - F.coalesce("n0", F.lit(0))).alias("pairs"),
                total.cast("decimal(38,0)").cast("double").alias("total"))
        .filter("pairs > 0")
    )


@query("""
WITH d AS (SELECT DISTINCT ON (p_brand, p_type) p_brand, p_type, p_name, p_partkey FROM part WHERE p_size >= 25
           ORDER BY p_brand, p_type, length(p_name) DESC, p_partkey)
SELECT p.p_partkey, d.p_name AS filled_value, d.p_partkey AS source_key,
       CASE WHEN d.p_partkey IS NULL THEN 'skipped' ELSE 'filled' END AS status
FROM part p LEFT JOIN d USING (p_brand, p_type) WHERE p.p_size < 25""")
def sibling_fill_text(spark, sf_dir):
    """Blank names filled by the longest name among parts of the same brand and type; decisions with skipped ones."""
    parts = table(spark, sf_dir, "part").withColumn("p_name", F.when(F.col("p_size") >= 25, F.col("p_name")))
    return enrich.sibling_decisions(parts, ["p_brand", "p_type"], "p_partkey", "p_name", is_blank_text)


@query("""
WITH f AS (SELECT DISTINCT ON (p_brand, lower(trim(p_name))) p_brand, p_name, p_partkey FROM part
           ORDER BY p_brand, lower(trim(p_name)), p_partkey)
SELECT p_brand, string_agg(p_name, '|' ORDER BY p_partkey) AS names FROM f GROUP BY p_brand""")
def sibling_fill_union(spark, sf_dir):
    """Union of names of each brand without case-insensitive repeats."""
    out = enrich.union_distinct_values(table(spark, sf_dir, "part"), ["p_brand"], "p_partkey", "p_name")
    return out.select("p_brand", F.array_join("values", "|").alias("names"))


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, n AS votes FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM c) WHERE r = 1""")
def vote_mode(spark, sf_dir):
    """Majority vote with a fixed rule for ties."""
    return rank.vote(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
    WHEN '3-MEDIUM' THEN 3 ELSE 99 END, CAST(o_orderkey AS VARCHAR)) AS r FROM orders) WHERE r = 1""")
def best_by_priority(spark, sf_dir):
    """Best row by a priority table (99 where it has none), then by the key as a string."""
    order = F.col("o_orderpriority")
    level = F.when(order == "1-URGENT", 1).when(order == "2-HIGH", 2).when(order == "3-MEDIUM", 3).otherwise(99)
    best = F.min(F.struct(level.alias("level"), F.col("o_orderkey").cast("string").alias("key"), "o_orderkey", "o_orderpriority"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(best.alias("b")).select("o_custkey", "b.o_orderkey", "b.o_orderpriority")


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark, sf_dir):
    """Latest row of each key."""
    best = F.max(F.struct("ts", "event_id", "event_type"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(best.alias("b")).select("user_id", "b.event_id", "b.event_type")


@query("""
SELECT c_custkey, CASE WHEN n = 0 THEN 'NO_ORDERS' WHEN big = 0 THEN 'ONLY_SMALL' WHEN urgent = 0 THEN 'NOT_URGENT' ELSE 'OK' END AS reason
FROM (SELECT c_custkey, count(o_orderkey) AS n, count(*) FILTER (WHERE o_totalprice > 400000) AS big,
             count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
      FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""")
def reason_codes(spark, sf_dir):
    """Why a key has no match: flags, then the first reason that holds."""
    flags = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 400000).alias("big"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    joined = table(spark, sf_dir, "customer").select("c_custkey").join(flags, "c_custkey", "left")
    reason = F.when(F.col("n").isNull(), "NO_ORDERS").when(F.col("big") == 0, "ONLY_SMALL").when(F.col("urgent") == 0, "NOT_URGENT").otherwise("OK")
    return joined.select("c_custkey", reason.alias("reason"))


_CHAIN = """
WITH u AS (SELECT c_nationkey, count(*) AS customers, count(*) FILTER (WHERE EXISTS (
    SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')) AS done FROM customer GROUP BY c_nationkey)
SELECT n_name, coalesce(customers, 0) AS customers, coalesce(done, 0) AS done,
  CASE WHEN coalesce(done, 0) = 0 THEN 'none' WHEN done = customers THEN 'all' ELSE 'partial' END AS category
FROM nation LEFT JOIN u ON c_nationkey = n_nationkey"""


def _category(df):
    df = df.select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("done", F.lit(0)).alias("done"))
    return df.withColumn("category", F.when(F.col("done") == 0, "none").when(F.col("done") == F.col("customers"), "all").otherwise("partial"))


@query(_CHAIN)
def chain_slow(spark, sf_dir):
    """Chain nation, customer, order with pass categories, joining all orders."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    joined = table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    per = joined.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.countDistinct("c_custkey").alias("customers"), F.countDistinct(F.when(F.col("o_orderkey").isNotNull(), F.col("c_custkey"))).alias("done")
    )
    return _category(table(spark, sf_dir, "nation").join(per, "n_nationkey", "left"))


@query(_CHAIN)
def chain_fast(spark, sf_dir):
    """The same chain with distinct keys before the join."""
    keys = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("f", F.lit(1))
    per = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(keys, "c_custkey", "left").groupBy(
        F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"), F.count("f").alias("done"))
    return _category(table(spark, sf_dir, "nation").join(per, "n_nationkey", "left"))


@query("""
SELECT category, id, CAST(NULL AS VARCHAR) AS note FROM (
  SELECT o_orderpriority AS category, o_orderkey AS id, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders)
WHERE r <= 3
UNION ALL SELECT category, id, 'segment' FROM (
  SELECT c_mktsegment AS category, c_custkey AS id, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS r FROM customer)
WHERE r <= 3""")
def stratified_sample(spark, sf_dir):
    """First three of each category (the feature: a sample), branches aligned by typed nulls."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("id"))
    b = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("category"), F.col("c_custkey").alias("id"))
    a, b = (rank.first_of(x, ["category"], [F.col("id")], 3) for x in (a, b))
    return b.withColumn("note", F.lit("segment")).unionByName(a, allowMissingColumns=True)


@query("""
SELECT DISTINCT value, kind FROM (SELECT p_brand AS value, 'brand' AS kind FROM part UNION ALL SELECT p_type, 'type' FROM part
  UNION ALL SELECT p_name, 'name' FROM part)""")
def union_distinct_unpivot(spark, sf_dir):
    """Several columns as rows of (value, kind), distinct."""
    parts = table(spark, sf_dir, "part")
    return parts.selectExpr("stack(3, p_brand, 'brand', p_type, 'type', p_name, 'name') AS (value, kind)").distinct()


@query("""
SELECT 'both' AS side, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'left', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def set_diff_intersect(spark, sf_dir):
    """Intersection and difference of key sets."""
    c = table(spark, sf_dir, "customer")
    both = c.select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))
    left = c.select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select("o_custkey"))
    return both.select(F.lit("both").alias("side"), F.col("k").cast("long").alias("k")).unionByName(left.select(F.lit("left").alias("side"), "k"))


def _old_new(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old = orders.filter("o_orderstatus <> 'O'").withColumn("o_totalprice", F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice")))
    new = orders.filter("o_orderstatus <> 'F'").withColumn("o_orderstatus", F.lit("N"))
    return old, new


_OLD_NEW = """
WITH o AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS o_totalprice FROM orders WHERE o_orderstatus <> 'O'),
n AS (SELECT o_orderkey, 'N' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F')"""


@query(_OLD_NEW + """
SELECT o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice
FROM o FULL JOIN n USING (o_orderkey)""")
def upsert_merge(spark, sf_dir):
    """Insert or update by key."""
    return merge.upsert(*_old_new(spark, sf_dir), ["o_orderkey"])


@query(_OLD_NEW + """, m AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 200000 THEN o_totalprice END AS o_totalprice FROM n)
SELECT o_orderkey, CASE WHEN m.o_orderstatus IS NOT NULL THEN m.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus, CASE WHEN m.o_orderstatus IS NOT NULL THEN m.o_totalprice ELSE o.o_totalprice END AS o_totalprice
FROM o FULL JOIN m USING (o_orderkey)""")
def upsert_overwrite(spark, sf_dir):
    """Insert or update by key, where nulls of the new row overwrite values."""
    old, new = _old_new(spark, sf_dir)
    new = new.withColumn("o_totalprice", F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")))
    return merge.upsert(old, new, ["o_orderkey"], nulls=True)


@query(_OLD_NEW + " SELECT * FROM o UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)")
def insert_ignore(spark, sf_dir):
    """Insert where the key is absent."""
    return merge.insert_ignore(*_old_new(spark, sf_dir), ["o_orderkey"])


@query(_OLD_NEW + """
SELECT o.o_orderkey, o.o_orderstatus, coalesce(o.o_totalprice, n.o_totalprice) AS o_totalprice FROM o LEFT JOIN n USING (o_orderkey)""")
def null_guard_update(spark, sf_dir):
    """Update of nulls only."""
    return merge.fill_nulls(*_old_new(spark, sf_dir), ["o_orderkey"], "o_totalprice")


@query("""
WITH s AS (SELECT CAST(floor(o_orderkey / 100000) AS BIGINT) AS bucket, o_orderkey FROM orders)
SELECT bucket, batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT bucket, o_orderkey, ntile(10) OVER (PARTITION BY bucket ORDER BY o_orderkey) AS batch FROM s) GROUP BY ALL""")
def ntile_batches(spark, sf_dir):
    """Equal batches by key, within key ranges so that no task sorts the whole table."""
    rows = table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 100000).alias("bucket"), "o_orderkey")
    batch = F.ntile(10).over(W.partitionBy("bucket").orderBy("o_orderkey"))
    return rows.withColumn("batch", batch).groupBy("bucket", "batch").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query("""
SELECT o_custkey, a.s AS value_before, b.s AS value_after
FROM (SELECT o_custkey, CASE WHEN sum(o_totalprice) > 2000000 THEN 'big' ELSE 'small' END AS s FROM orders GROUP BY 1) a
FULL JOIN (SELECT o_custkey, CASE WHEN sum(o_totalprice) > 2500000 THEN 'big' ELSE 'small' END AS s FROM orders GROUP BY 1) b USING (o_custkey)
WHERE a.s IS DISTINCT FROM b.s""")
def run_diff(spark, sf_dir):
    """Decisions that differ between two runs under different thresholds."""
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("t"))
    runs = [sums.select("o_custkey", F.when(F.col("t") > x, "big").otherwise("small").alias("s")) for x in (2000000, 2500000)]
    return merge.diff_runs(*runs, ["o_custkey"], "s")


#: Suppliers, the parts that they ship and the orders that they ship for; parts and orders have few suppliers each.
_GRAPH = """
WITH e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst, 'part' AS type FROM lineitem UNION ALL SELECT DISTINCT l_suppkey, l_orderkey, 'order' FROM lineitem)"""


def _edges(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    both = lines.selectExpr("stack(2, l_suppkey, l_partkey, 'part', l_suppkey, l_orderkey, 'order') AS (src, dst, type)")
    return both.distinct()


@query(_GRAPH + """
SELECT x.src AS a, y.src AS b, count(*) AS paths FROM e x JOIN e y ON x.dst = y.dst AND x.type = 'part' AND y.type = 'part' AND x.src <> y.src GROUP BY ALL""")
def graph_two_hop(spark, sf_dir):
    """Suppliers that meet in a part, with the count of parts."""
    return graph.two_hop(_edges(spark, sf_dir), "part", "part")


@query(_GRAPH + """
SELECT DISTINCT x.src AS a, y.src AS b FROM e x JOIN e y ON x.dst = y.dst AND x.type = 'order' AND y.type = 'order' AND x.src <> y.src
SEMI JOIN (SELECT DISTINCT u.src AS p, v.src AS q FROM e u JOIN e v ON u.dst = v.dst AND u.type = 'part' AND v.type = 'part') t ON p = x.src AND q = y.src""")
def graph_alternatives(spark, sf_dir):
    """Suppliers that share an order and a part, both directions."""
    return graph.alternatives(_edges(spark, sf_dir), "order", "part")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def graph_optional_count(spark, sf_dir):
    """Nodes whose optional match is empty: customers without a pending order."""
    edges = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.col("o_orderstatus").alias("type"))
    return graph.without(table(spark, sf_dir, "customer").select("c_custkey"), edges, "c_custkey", "P")


@query("""
SELECT o_custkey, o_orderkey, price, place FROM (
  SELECT o_custkey, o_orderkey, price, row_number() OVER (PARTITION BY o_custkey ORDER BY price DESC NULLS LAST, o_orderkey) AS place
  FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)) WHERE place <= 3""")
def nulls_last_sort(spark, sf_dir):
    """Top three with nulls last (the feature: a top-k report)."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    place = F.row_number().over(W.partitionBy("o_custkey").orderBy(F.col("price").desc_nulls_last(), "o_orderkey"))
    return rows.withColumn("place", place).filter("place <= 3")


_RULES = """
r AS (SELECT * FROM (VALUES (1, NULL, 10.0, 'any', 'any'), (2, 10.0, 30.0, 'any', 'any'), (3, 30.0, NULL, 'any', 'any'),
  (4, 20.0, NULL, 'R', 'any'), (5, NULL, 25.0, 'any', 'O'), (6, 5.0, 45.0, 'A', 'F')) AS t(rule_id, lo, hi, flag, status))"""


@query(f"""
WITH {_RULES} SELECT rule_id, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem JOIN r
ON (lo IS NULL OR l_quantity >= lo) AND (hi IS NULL OR l_quantity <= hi) AND flag IN (l_returnflag, 'any') AND status IN (l_linestatus, 'any')
GROUP BY rule_id""")
def open_range_match(spark, sf_dir):
    """Rows matched to rules with open bounds and wildcards (six rules, broadcast)."""
    return _matched(spark, sf_dir).groupBy("rule_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


def _matched(spark, sf_dir):
    rules = spark.sql(f"WITH {_RULES} SELECT rule_id, double(lo) AS lo, double(hi) AS hi, flag, status FROM r")
    on = F.expr(
        "(lo IS NULL OR l_quantity >= lo) AND (hi IS NULL OR l_quantity <= hi) AND flag IN (l_returnflag, 'any') AND status IN (l_linestatus, 'any')"
    )
    return table(spark, sf_dir, "lineitem").join(F.broadcast(rules), on)


@query(f"""
WITH {_RULES}, m AS (SELECT l_orderkey, l_linenumber, rule_id,
  (lo IS NOT NULL)::INT + (hi IS NOT NULL)::INT + (flag <> 'any')::INT + (status <> 'any')::INT AS score FROM lineitem JOIN r
  ON (lo IS NULL OR l_quantity >= lo) AND (hi IS NULL OR l_quantity <= hi) AND flag IN (l_returnflag, 'any') AND status IN (l_linestatus, 'any')),
b AS (SELECT l_orderkey, l_linenumber, max(score * 100 - rule_id) AS best FROM m GROUP BY ALL)
SELECT CAST(((100 - best % 100) % 100) AS BIGINT) AS rule_id, count(*) AS n FROM b GROUP BY 1""")
def specificity_rank(spark, sf_dir):
    """The most specific rule of each line key, the first of equally specific ones, counted; rules are tried within the row."""
    rule = rank.most_specific(
        [
            (1, [F.col("l_quantity") <= 10]),
            (2, [F.col("l_quantity") >= 10, F.col("l_quantity") <= 30]),
            (3, [F.col("l_quantity") >= 30]),
            (4, [F.col("l_quantity") >= 20, F.col("l_returnflag") == "R"]),
            (5, [F.col("l_quantity") <= 25, F.col("l_linestatus") == "O"]),
            (6, [F.col("l_quantity") >= 5, F.col("l_quantity") <= 45, F.col("l_returnflag") == "A", F.col("l_linestatus") == "F"]),
        ]
    )
    best = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(rule).alias("b")).filter("b IS NOT NULL")
    return best.groupBy(F.col("b.rule").cast("long").alias("rule_id")).agg(F.count("*").alias("n"))


@query("""
SELECT l_orderkey, l_linenumber, pack, CAST(ceil(l_quantity / pack) AS BIGINT) AS packs, CAST(ceil(l_quantity / pack) * pack - l_quantity AS DOUBLE) AS waste
FROM (SELECT l_orderkey, l_linenumber, l_quantity, pack, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
  ORDER BY ceil(l_quantity / pack) + ceil(l_quantity / pack) * pack - l_quantity, pack) AS r
  FROM lineitem, (SELECT unnest([5, 7, 12]) AS pack) WHERE l_returnflag = 'R') WHERE r = 1""")
def pill_burden(spark, sf_dir):
    """Packs of the least count plus waste, over a fixed list of pack sizes, within the row."""
    q = F.col("l_quantity")
    options = F.transform(
        F.array(*[F.lit(p) for p in (5, 7, 12)]),
        lambda p: F.struct(
            (F.ceil(q / p) + F.ceil(q / p) * p - q).alias("cost"), p.alias("pack"), F.ceil(q / p).alias("packs"), (F.ceil(q / p) * p - q).alias("waste")
        ),
    )
    rows = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumn("b", F.array_min(options))
    return rows.select("l_orderkey", "l_linenumber", "b.pack", "b.packs", "b.waste")
