"""Patterns over an edge table (src, dst, type), at most two hops.

Two sources meet in a target, so a hub with d sources has d * d ways through it. Targets with up to `ways` ways are
joined as they are; those with more are split: both sides of the hub are dealt into blocks, and each two blocks meet in a
cell of about BLOCK * BLOCK pairs. Blocks are sent, not rows, so that d * d / `BLOCK` is what a hub's shuffle grows with.

Pairs are counted where their first source is, so that ways are neither rows of a shuffle nor kept in a map of all pairs by
every task. Few ways: each edge is sent there with the list of sources that its target leads to. Many: sources that are next
to each other by their least target share a home, and each target sends its list once to a home, however many of its
sources are there. Pairs of one kind of edge are counted once, a < b.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import stage

WAYS = 1 << 20
#: Hubs that are broadcast at most; more are joined by a shuffle.
FEW_HUBS = 100_000
#: Sources of a hub, or members of a class, that travel as one row.
BLOCK = 1 << 9
#: Ways up to which each source is its own home.
FEW_WAYS = 1 << 25
#: Times WAYS that a source may have ways of its own for them to meet in one task, and that a task has on average.
BUSY, TASK = 16, 4


def _products(met: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (a, b) for each row (p, q) of `met`, with its other columns: every a of p in `left` with every b of q in `right`.

    Members travel in blocks, and two blocks make a cell of about BLOCK * BLOCK pairs, so that what is shuffled is a small
    part of the pairs, and cells are dealt to tasks whatever they belong to.
    """
    cells, blocks = met, []
    for members, c, key, i in ((left, "a", "p", "i"), (right, "b", "q", "j")):
        n, many = stage(members.groupBy(key).agg(F.count("*").alias(f"n_{key}"))), F.ceil(F.col(f"n_{key}") / BLOCK).cast("int")
        rows = members.join(n, key).groupBy(key, F.pmod(F.xxhash64(c), many).cast("int").alias(i))
        blocks.append(stage(rows.agg(F.sort_array(F.collect_list(c)).alias(f"{c}s"))))
        cells = cells.join(n.withColumn(i, F.sequence(F.lit(0), many - 1)), key)
    cells = stage(cells)
    pairs = cells.agg(F.coalesce(F.sum(F.col("n_p") * F.col("n_q")), F.lit(0))).first()[0]
    cells = cells.drop("n_p", "n_q").withColumn("i", F.explode("i")).withColumn("j", F.explode("j"))
    cell, parts = ["p", "i", "q", "j"], _tasks(met, pairs)
    one = cells.join(blocks[0], ["p", "i"]).repartition(parts, *cell)
    two = cells.select(*cell).join(blocks[1], ["q", "j"]).repartition(parts, *cell)
    rest = [c for c in met.columns if c not in ("p", "q")]
    return one.join(two, cell).select(F.explode("as").alias("a"), "bs", *rest).select("a", F.explode("bs").alias("b"), *rest)


def _tasks(df: DataFrame, pairs: int) -> int:
    """Tasks for so many pairs: as many as Spark would take, or more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(10_000, pairs // (TASK * WAYS) + 1))


def _meetings(x: DataFrame, y: DataFrame, ways: int = WAYS) -> DataFrame:
    """Pairs (a, b) of the rows (a, dst) of x and (b, dst) of y, one for each way."""
    n_x, n_y = (side.groupBy("dst").agg(F.count("*").alias(f"n_{c}")) for side, c in ((x, "x"), (y, "y")))
    hubs = stage(n_x.join(n_y, "dst").filter(F.col("n_x") * F.col("n_y") > ways).select("dst"))
    few = hubs.count()
    if not few:
        return x.join(y, "dst").select("a", "b")
    hubs = F.broadcast(hubs) if few <= FEW_HUBS else hubs
    light = x.join(hubs, "dst", "left_anti").join(y, "dst").select("a", "b")
    p, q = (side.join(hubs, "dst", "left_semi").withColumnRenamed("dst", c) for side, c in ((x, "p"), (y, "q")))
    return light.unionByName(_products(hubs.select(F.col("dst").alias("p"), F.col("dst").alias("q")), p, q))


def _of(edges: DataFrame, kind: str, name: str) -> DataFrame:
    return edges.filter((F.col("type") == kind) & F.col("dst").isNotNull()).select(F.col("src").alias(name), "dst")


def _shapes(side: DataFrame, c: str) -> DataFrame:
    """The number of targets of each source, the least and the greatest."""
    return stage(side.groupBy(c).agg(F.count("*").alias("_n"), F.min("dst").alias("_lo"), F.max("dst").alias("_hi")))


def _classes(side: DataFrame, c: str, name: str) -> DataFrame:
    """Rows (c, name): sources with the same targets share a class, named by the least of them. Sets of targets are compared
    by their sizes and two sums of hashes."""
    hashes = [F.sum(F.xxhash64(F.lit(k), "dst").cast("decimal(38,0)")).alias(f"_h{k}") for k in (1, 2)]
    shapes = stage(side.groupBy(c).agg(F.count("*").alias("_n"), *hashes))
    named = shapes.groupBy("_n", "_h1", "_h2").agg(F.min(c).alias(name))
    return stage(shapes.join(named, ["_n", "_h1", "_h2"]).select(c, name))


def _homes(sources: DataFrame, parts: int) -> DataFrame:
    """Rows (a, home): sources in the order of their least targets, in up to `parts` homes of about as many edges each."""
    unit = max(1, (sources.agg(F.sum("_n")).first()[0] or 0) // (64 * parts))
    units = sources.select("a", "_lo", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_n") / unit).cast("int"))))
    ranged = units.repartitionByRange(parts, "_lo", "a").select("a", F.spark_partition_id().alias("home"))
    return stage(ranged.groupBy("a").agg(F.min("home").alias("home")))


def _parcels(x: DataFrame, y: DataFrame | None, homes: DataFrame) -> DataFrame:
    """Rows (home, as, bs), one for a target and a home: its sources there, and those that they meet. Without y, these are the
    target's sources in half of the other homes, since of two homes the lesser one has their pairs if their sum is even, else
    the greater one; those in `as`, which is sorted, meet each other as well."""
    x = x.join(homes, "a")
    if y is not None:
        here = x.repartition("dst").groupBy("dst", "home").agg(F.collect_list("a").alias("as"))
        return here.join(y.groupBy("dst").agg(F.collect_list("b").alias("bs")), "dst").select("home", "as", "bs")
    # Even homes come first, then odd ones, both in order, so that all that a home has are stretches of one array.
    odd, home, n = F.col("home") % 2, F.col("home"), F.size("all")
    met = x.groupBy("dst").agg(F.sort_array(F.collect_list(F.struct(odd.alias("odd"), "home", "a"))).alias("l")).filter(F.size("l") > 1)
    met = met.select(F.col("l.a").alias("all"), F.col("l.home").alias("of"), F.array_position("l.odd", 1).cast("int").alias("odds"))
    met = met.withColumns({"evens": F.when(F.col("odds") == 0, n).otherwise(F.col("odds") - 1), "ranked": F.sort_array("of"), "homes": F.array_distinct("of")})
    met = met.select("*", F.posexplode("homes").alias("k", "home"))
    following = F.array_position("of", F.get("homes", F.col("k") + 1)).cast("int")
    met = met.withColumns({"at": F.array_position("of", home).cast("int"), "end": F.coalesce(following, n + 1)})
    first, last = F.when(odd == 1, F.col("evens") + 1).otherwise(1), F.when(odd == 1, n).otherwise(F.col("evens"))
    lesser = F.array_position("ranked", home).cast("int") - 1 - (F.col("at") - first)  # in homes of the other kind
    later = F.slice("all", F.col("end"), last - F.col("end") + 1)
    earlier = F.slice("all", F.when(odd == 1, 1).otherwise(F.col("evens") + 1), lesser)
    met = met.select("home", F.slice("all", F.col("at"), F.col("end") - F.col("at")).alias("as"), F.concat(later, earlier).alias("bs"))
    return met.filter(F.size("as") + F.size("bs") > 1)


def _pairs(kinds: list[tuple[DataFrame, DataFrame | None, int]], summary: Callable[[Column], Column], ways: int, sources: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of the rows (a, dst) and (b, dst) of each kind, with the summary `v` of the kinds' values, one for each
    way. Without rows (b, dst), in any kind, they are the rows (a, dst), and each pair comes once, as a < b. `sources` are
    the shapes of all a.

    Ways through hubs and those of busy sources are made apart and meet by a shuffle of pairs; `summary` can be repeated.
    """
    twin = kinds[0][1] is None
    keep = F.col("a") < F.col("b") if twin else F.lit(True)
    sources = _shapes(reduce(DataFrame.unionByName, [x for x, _, _ in kinds]), "a") if sources is None else sources
    most, least, last = sources.agg(F.coalesce(F.max("_n"), F.lit(0)), F.min("a"), F.max("a")).first()
    sides, apart, total = [], [], 0
    for x, y, value in kinds:
        n_x = x.groupBy("dst").agg(F.count("*").alias("n_x"))
        n_y = n_x.withColumn("n_y", F.col("n_x")) if twin else n_x.join(y.groupBy("dst").agg(F.count("*").alias("n_y")), "dst")
        other = x.withColumnRenamed("a", "b") if twin else y
        crowds = stage(n_y.select("dst", "n_y", (F.col("n_x") * F.col("n_y")).alias("crowd")))
        sums = crowds.agg(*(F.coalesce(f, F.lit(0)) for f in (F.sum("crowd"), F.max("crowd"), F.max("n_y")))).first()
        total += sums[0] // 2 if twin else sums[0]
        if sums[1] > ways:
            hubs = crowds.filter(F.col("crowd") > ways).select("dst")
            apart.append(_meetings(x.join(hubs, "dst", "left_semi"), other, ways).select("a", "b", F.lit(value).cast("long").alias("v")))
            x = x.join(hubs, "dst", "left_anti")
        if most * sums[2] > BUSY * ways:
            busy = stage(x.join(crowds, "dst").groupBy("a").agg(F.sum("n_y").alias("n")).filter(F.col("n") > BUSY * ways).select("a"))
            if not busy.isEmpty():
                apart.append(_meetings(x.join(busy, "a", "left_semi"), other, ways).select("a", "b", F.lit(value).cast("long").alias("v")))
                if twin:  # the others meet busy sources too
                    apart.append(_meetings(x.join(busy, "a", "left_anti"), x.join(busy, "a", "left_semi").withColumnRenamed("a", "b"), ways).select("a", "b", F.lit(value).cast("long").alias("v")))
                x = x.join(busy, "a", "left_anti")
        sides.append((x, y, F.lit(value).cast("long").alias("v")))
    parts = _tasks(sources, total)
    if total <= FEW_WAYS:
        lists = []
        for x, y, v in sides:
            others = (x.withColumnRenamed("a", "b") if twin else y).groupBy("dst").agg(F.collect_list("b").alias("bs"))
            lists.append(x.join(others, "dst").select("a", F.filter("bs", lambda b: b > F.col("a")).alias("bs") if twin else "bs", v))
        met = reduce(DataFrame.unionByName, lists).repartition(parts, "a").select("a", F.explode("bs").alias("b"), "v")
        out = met.groupBy("a", "b").agg(summary(F.col("v")).alias("v"))
    else:
        kind, homes = sources.schema["a"].dataType, _homes(sources, parts)
        small = twin and kind.typeName() == "long" and least is not None and -(1 << 31) <= least and last < 1 << 31  # half of what is shuffled
        if small:
            sides = [(x.withColumn("a", F.col("a").cast("int")), y, v) for x, y, v in sides]
            homes = homes.withColumn("a", F.col("a").cast("int"))
        met = reduce(DataFrame.unionByName, [_parcels(x, y, homes).select("*", v) for x, y, v in sides]).repartitionById(parts, F.col("home"))
        if twin:
            met = met.select("*", F.posexplode("as").alias("k", "c"))
            met = met.select("home", "v", "c", F.explode(F.concat(F.slice("as", F.col("k") + 2, F.size("as")), "bs")).alias("d"))
            met = met.select("home", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), "v")
        else:
            met = met.select("home", "v", "bs", F.explode("as").alias("a")).select("home", "a", F.explode("bs").alias("b"), "v")
        out = met.groupBy("home", "a", "b").agg(summary(F.col("v")).alias("v"))
        out = out.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b") if twin else "b", "v")
    if apart:
        out = reduce(DataFrame.unionByName, apart).filter(keep).unionByName(out).groupBy("a", "b").agg(summary(F.col("v")).alias("v"))
    return out


def two_hop(edges: DataFrame, first: str, second: str, ways: int = WAYS) -> DataFrame:
    """Pairs of sources that meet in a target, one by each type: a, b, paths.

    Where most sources share their set of targets with others, paths are counted between such classes, and pairs are only
    written out, without a shuffle or an aggregate of them.
    """
    x = stage(_of(edges, first, "a").distinct())
    y = None if first == second else stage(_of(edges, second, "b").distinct())
    shapes = [_shapes(x, "a")] if y is None else [_shapes(x, "a"), _shapes(y, "b")]
    apart = sum(s.select("_n", "_lo", "_hi").distinct().count() for s in shapes)  # classes at least
    many = 2 * apart > sum(s.count() for s in shapes)
    if not many:
        p = _classes(x, "a", "p")
        q = p.withColumnsRenamed({"a": "b", "p": "q"}) if y is None else _classes(y, "b", "q")
        many = 2 * (p.filter("a = p").count() + q.filter("b = q").count()) > p.count() + q.count()
    if many:
        pairs = _pairs([(x, y, 1)], F.sum, ways, shapes[0])
        if y is None:
            pairs = pairs.select(F.stack(F.lit(2), "a", "b", "b", "a").alias("a", "b"), "v")
        return pairs.filter("a <> b").withColumnRenamed("v", "paths")
    y = (x.withColumnRenamed("a", "b") if y is None else y).join(q.filter("b = q").select("b"), "b", "left_semi")
    x = x.join(p.filter("a = p").select("a"), "a", "left_semi")
    pairs = stage(_pairs([(x, y, 1)], F.sum, ways).withColumnsRenamed({"a": "p", "b": "q", "v": "paths"}))
    return _products(pairs, p, q).filter("a <> b")


def alternatives(edges: DataFrame, first: str, second: str, ways: int = WAYS) -> DataFrame:
    """Sources that share a target by each of two types, both directions: a, b.

    Only edges of sources that share a target by the type with fewer ways are expanded. Both types' pairs meet in one
    aggregate, each pair once, from its lesser source.
    """
    e = stage(edges.select("src", "dst", "type").filter(F.col("type").isin(first, second)).distinct())
    crowds = stage(e.groupBy("type", "dst").agg(F.count("*").alias("n")))
    ways_of = {r["type"]: r["ways"] for r in crowds.groupBy("type").agg(F.sum(F.col("n") * F.col("n")).alias("ways")).collect()}
    rare = min((first, second), key=lambda t: ways_of.get(t, 0))
    shared = crowds.filter((F.col("type") == rare) & (F.col("n") > 1)).select("type", "dst")
    e = stage(e.join(stage(e.join(shared, ["type", "dst"], "left_semi").select("src").distinct()), "src", "left_semi"))
    kinds = [(_of(e, kind, "a"), None, bit) for bit, kind in enumerate((first, second), 1)]
    both = stage(_pairs(kinds, F.bit_or, ways).filter(F.col("v") == 3).select("a", "b"))
    return both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))


def without(nodes: DataFrame, edges: DataFrame, key: str, kind: str) -> DataFrame:
    """Nodes with no edge of a type (an optional match whose count is 0)."""
    return nodes.join(edges.filter(F.col("type") == kind).select(F.col("src").alias(key)), key, "left_anti")


def mirror_gaps(edges: DataFrame, parts: int) -> DataFrame:
    """Distinct edges (a, b) whose reverse is missing. An edge and its reverse meet in one of `parts` groups of rows, which
    bound what a task holds; an edge with a null has no reverse, one from a node to itself is its own."""
    turned = F.coalesce(F.col("a") > F.col("b"), F.lit(False))
    lo, hi = F.when(turned, F.col("b")).otherwise(F.col("a")), F.when(turned, F.col("a")).otherwise(F.col("b"))
    rows = edges.filter(F.coalesce(F.col("a") != F.col("b"), F.lit(True))).select(lo.alias("lo"), hi.alias("hi"), F.when(turned, 2).otherwise(1).alias("way"))
    one = rows.repartition(parts, "lo", "hi").groupBy("lo", "hi").agg(F.bit_or("way").alias("ways")).filter("ways < 3")
    back = F.col("ways") == 2
    return one.select(F.when(back, F.col("hi")).otherwise(F.col("lo")).alias("a"), F.when(back, F.col("lo")).otherwise(F.col("hi")).alias("b"))
