"""JSON documents as rows of typed nodes, and back.

A node is (path, kind, value): the path is an array of names, so a name may hold any character; the kind is object,
array, string, number, boolean, null or invalid; the value is canonical JSON text. Documents are parsed once, by the
type of each value and not by its looks: a string that begins with "{" is a string, {} and [] are values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import stage

#: Levels that one pass over the staged rows opens.
LEVELS = 3
PATH = "array<string>"


def kind_of(value: Column) -> Column:
    """The kind of canonical JSON text, from its first character."""
    kinds = {"{": "object", "[": "array", '"': "string", "t": "boolean", "f": "boolean", "n": "null"}
    names = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.substring(value, 1, 1)), F.lit("number"))


def is_gap(value: Column) -> Column:
    """Whether canonical JSON text is a gap: null, a blank string, an empty array or object."""
    return value.isNull() | value.isin("null", "[]", "{}") | value.rlike(r'(?U)^"(?:\s|\\[nrtfb]|\\u000[bB])*"$')


def walk(df: DataFrame, key: str, doc: str, inner: bool = False, items: bool = False, under: str | None = None) -> DataFrame:
    """Rows key, path, kind, value of the nodes of the JSON documents in column `doc`, to any depth.

    Leaves are all values but objects with fields; an array is one leaf, or with `items` each of its items goes on under
    a null in place of a name. `inner` adds the objects (and with `items` the arrays) themselves. `under` names a column
    with the path that a document stands at. A document that is no object has one row, with the path it stands at;
    text that is no JSON has the kind "invalid" and its text as a JSON string; a null document has none.

    The table is read once: each round opens LEVELS levels of what is still nested and stages the result, until nothing
    is; a path of 18 names takes six rounds over ever fewer rows.
    """
    spark = df.sparkSession
    start = F.col(f"`{under}`") if under else F.array()
    parsed = df.filter(F.col(f"`{doc}`").isNotNull()).select(
        F.col(f"`{key}`").alias("k"), start.cast(PATH).alias("path"), F.col(f"`{doc}`").alias("text"), F.try_parse_json(doc).alias("v")
    )
    bad = F.col("v").isNull()
    level = parsed.select("k", "path", F.when(bad, F.col("text").cast("variant")).otherwise(F.col("v")).alias("v"), bad.alias("bad"))

    def opens(v: str) -> str:
        full = f"(schema_of_variant({v}) LIKE 'OBJECT<%' AND schema_of_variant({v}) <> 'OBJECT<>')"
        return f"({full} OR (schema_of_variant({v}) LIKE 'ARRAY%' AND to_json({v}) <> '[]'))" if items else full

    joins, v, path = "", "l.v", "l.path"
    for i in range(1 if inner else LEVELS):
        joins += f", LATERAL variant_explode_outer(CASE WHEN {opens(v)} THEN {v} END) x{i}"
        path = f"CASE WHEN x{i}.pos IS NULL THEN {path} ELSE concat({path}, array(x{i}.key)) END"
        v = f"CASE WHEN x{i}.pos IS NULL THEN {v} ELSE x{i}.value END"
    one_round = f"SELECT *, {opens('v')} AS nested FROM (SELECT l.k, {path} AS path, {v} AS v, l.bad FROM {{rows}} l{joins})"
    found = []
    if inner:
        found.append(stage(level.withColumn("nested", F.expr(opens("v")))))
        level = found[0].filter("nested")
    while not found or not level.isEmpty():
        step = stage(spark.sql(one_round, rows=level))
        found.append(step if inner else step.filter("NOT nested"))
        level = step.filter("nested")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = out.select(F.col("k").alias(key), "path", F.to_json("v").alias("value"), "bad")
    kind = F.when(F.col("bad"), "invalid").otherwise(kind_of(F.col("value")))
    return out.select(key, "path", kind.alias("kind"), "value")


def _text(name: Column) -> Column:
    """A name as a JSON string."""
    quoted = F.to_json(F.array(name))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def assembled(leaves: Column) -> Column:
    """The JSON text of an array of leaves (path, value), in one pass over the leaves in order of their paths.

    Between two leaves the objects that end are closed and those that begin are opened. A leaf at the empty path is the
    whole document. No path may lead through another leaf; of repeated paths, the last one is taken.
    """
    order = F.array_sort(leaves)

    def piece(x: Column, i: Column, rows: Column) -> Column:
        path, n = x["path"], F.size(x["path"])
        before = F.when(i > 0, F.get(rows, i - 1)["path"]).otherwise(F.array().cast(PATH))
        depths = F.sequence(F.lit(1), F.least(F.size(before), n))
        shared = F.when(F.least(F.size(before), n) > 0, F.size(F.filter(depths, lambda d: F.slice(before, F.lit(1), d) == F.slice(path, F.lit(1), d)))).otherwise(0)
        closed = F.repeat(F.lit("}"), F.greatest(F.size(before) - 1 - shared, F.lit(0)))
        opened = F.transform(F.slice(path, shared + 1, F.greatest(n - shared - 1, F.lit(0))), lambda p: F.concat(_text(p), F.lit(":{")))
        return F.concat(closed, F.when(i > 0, ",").otherwise(""), F.array_join(opened, ""), _text(F.element_at(path, n)), F.lit(":"), x["value"])

    def document(rows: Column) -> Column:
        kept = F.filter(rows, lambda x, i: F.coalesce(F.get(rows, i + 1)["path"] != x["path"], F.lit(True)))
        return F.get(F.transform(F.array(kept), whole), F.lit(0))

    def whole(rows: Column) -> Column:
        pieces = F.transform(rows, lambda x, i: piece(x, i, rows))
        text = F.concat(F.lit("{"), F.array_join(pieces, ""), F.repeat(F.lit("}"), F.size(F.element_at(rows, -1)["path"])))
        return F.when(F.size(F.element_at(rows, 1)["path"]) == 0, F.element_at(rows, 1)["value"]).otherwise(text)

    return F.when(F.size(order) > 0, F.get(F.transform(F.array(order), document), F.lit(0)))


def assemble(leaves: DataFrame, key: str) -> DataFrame:
    """Documents from rows key, path, value (and any other columns): key, doc. One shuffle, by the key."""
    rows = leaves.groupBy(key).agg(F.collect_list(F.struct("path", "value")).alias("leaves"))
    return rows.select(key, assembled(F.col("leaves")).alias("doc"))


def set_paths(df: DataFrame, key: str, doc: str, fills: DataFrame) -> DataFrame:
    """key, doc: the documents with all `fills` (key, path, value as JSON text) set, in order of length of path, then path.

    A fill replaces what stands at its path, with all that is below, or adds a name to an object; where the parent is
    no object of the document by then, it changes nothing. Arrays are set whole, never their items. Of several fills of
    one path the greatest value is set. Documents without fills come back in canonical form; null stays null.
    """
    fills = fills.filter(F.size("path") > 0).groupBy(key, "path").agg(F.max("value").alias("value"))
    leaf = F.struct("path", "value")
    own = walk(df, key, doc).groupBy(key).agg(F.collect_list(leaf).alias("leaves"))
    numbered = stage(fills.select(F.struct(F.col(key).alias("k"), "path").alias("fill"), "path", "value"))
    new = walk(numbered, "fill", "value", under="path").groupBy("fill").agg(F.collect_list(leaf).alias("leaves"))
    by_key = new.groupBy(F.col("fill.k").alias("k")).agg(
        F.array_sort(F.collect_list(F.struct(F.size("fill.path").alias("n"), F.col("fill.path").alias("path"), "leaves"))).alias("fills")
    )

    def put(state: Column, fill: Column) -> Column:
        n, path = fill["n"], fill["path"]
        parent = F.slice(path, F.lit(1), n - 1)
        below = F.exists(state, lambda x: (F.size(x["path"]) >= n) & (F.slice(x["path"], F.lit(1), n - 1) == parent))
        empty = F.exists(state, lambda x: (x["path"] == parent) & (x["value"] == "{}"))
        rest = F.filter(state, lambda x: (F.slice(x["path"], F.lit(1), n) != path) & ~((x["path"] == parent) & (x["value"] == "{}")))
        return F.when(below | empty, F.concat(rest, fill["leaves"])).otherwise(state)

    both = own.join(by_key, F.col(f"`{key}`").eqNullSafe(F.col("k")), "left")
    leaves = F.coalesce(F.aggregate("fills", F.col("leaves"), put), F.col("leaves"))
    done = both.select(F.col(f"`{key}`").alias("k"), assembled(leaves).alias("filled"))
    return df.join(done, F.col(f"`{key}`").eqNullSafe(F.col("k")), "left").select(f"`{key}`", F.col("filled").alias(doc))


def merge(df: DataFrame, key: str, template: str, record: str, extra: bool = True) -> DataFrame:
    """key, doc: the document in column `record` over that in `template`: objects merge by name, else the record wins.

    With `extra` names that the template lacks stay, without they go. A null on one side counts as {}.
    """
    def begins(x: Column, y: Column) -> Column:
        return (F.size(x["path"]) <= F.size(y["path"])) & (F.slice(y["path"], F.lit(1), F.size(x["path"])) == x["path"])

    def leaves(doc: str) -> DataFrame:
        rows = df.select(F.struct(F.col(f"`{key}`").alias("k")).alias("s"), F.coalesce(F.col(f"`{doc}`"), F.lit("{}")).alias("doc"))
        return walk(rows, "s", "doc").groupBy("s").agg(F.collect_list(F.struct("path", "value")).alias("leaves"))

    both = leaves(template).withColumnRenamed("leaves", "t").join(leaves(record).withColumnRenamed("leaves", "r"), "s")
    t, r = F.col("t"), F.col("r")
    # An empty object changes nothing where the template has an object.
    wins = F.filter(r, lambda x: ~((x["value"] == "{}") & F.exists(t, lambda y: begins(x, y) & (y["path"] != x["path"]))))
    if not extra:
        known = lambda x: F.exists(t, lambda y: begins(x, y) | (begins(y, x) & (y["value"] != "{}")))
        wins = F.filter(wins, known)
    with_wins = both.withColumn("w", wins)
    w = F.col("w")
    stays = F.filter(t, lambda x: ~F.exists(w, lambda y: begins(x, y) | begins(y, x)))
    return with_wins.select(F.col("s.k").alias(key), assembled(F.concat(stays, w)).alias("doc"))


def rendered(path: Column) -> Column:
    """A path as text: `$.name`, with quotes around names that are no identifiers, and [*] for items of arrays."""

    def part(name: Column) -> Column:
        plain = name.rlike("^[A-Za-z0-9_]+$")
        return F.when(name.isNull(), "[*]").when(plain, F.concat(F.lit("."), name)).otherwise(F.concat(F.lit('."'), name, F.lit('"')))

    return F.concat(F.lit("$"), F.array_join(F.transform(path, part), ""))


def fill_maps(decisions: DataFrame, key: str) -> DataFrame:
    """The decided fills of each document as one map from rendered path to value: key, fills."""
    filled = decisions.filter("status = 'filled'").select(key, rendered(F.col("path")).alias("path"), "filled_value")
    return filled.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("path", "filled_value"))).alias("fills"))


def catalogue(df: DataFrame, key: str, doc: str) -> DataFrame:
    """Every path of the documents, items of arrays as null: path, depth, n (nodes), the count of each kind, values (distinct leaves)."""
    nodes = walk(df, key, doc, inner=True, items=True).filter(F.size("path") > 0)
    kinds = ("object", "array", "string", "number", "boolean", "null")
    return nodes.groupBy("path").agg(
        F.size("path").alias("depth"),
        F.count("*").alias("n"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds],
        F.countDistinct(F.when(~F.col("kind").isin("object", "array"), F.col("value"))).alias("values"),
    )


def template(paths: DataFrame) -> DataFrame:
    """The one document that all shapes fit into, from `catalogue`: doc, depth. Objects win over values, items of arrays
    merge into one object, and anything else is null."""
    named = paths.select(F.filter("path", lambda p: p.isNotNull()).alias("path"), F.col("n_object") + F.col("n_array") > 0)
    open_at, leaf = named.columns[1], F.struct("path", "value")
    merged = named.filter(F.size("path") > 0).groupBy("path").agg(F.max(open_at).alias("opens"))
    inner = merged.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda k: F.struct(F.slice("path", F.lit(1), k).alias("at"), (k < F.size("path")).alias("deeper")))).alias("x"))
    deeper = inner.groupBy("x.at").agg(F.max("x.deeper").alias("deeper"))
    leaves = merged.join(deeper.filter("NOT deeper").select(F.col("at").alias("path")), "path", "left_semi")
    value = F.when(F.col("opens"), "{}").otherwise("null")
    return leaves.withColumn("value", value).agg(F.collect_list(leaf).alias("leaves"), F.max(F.size("path")).alias("depth")).select(assembled(F.col("leaves")).alias("doc"), "depth")


def fill_decisions(df: DataFrame, key: str, group: list[str], doc: str) -> DataFrame:
    """One row for each gap of each document: key, path, original_value, filled_value, source_key, sibling_count, status.

    A gap is a null, blank string, empty array or empty object at a path that the document has. Among the documents of
    the same group, the longest value at that path that is no gap fills it, an object or array whole; of equally long
    ones, that of the least key. sibling_count tells how many there are; the status is "filled" or
    "skipped_no_sibling_value". Rows with a null in the group have no siblings.
    """
    nodes = walk(df, key, doc, inner=True).filter(F.size("path") > 0)
    rows = stage(df.select(F.col(key).alias("k"), *group).join(nodes, F.col("k") == F.col(key)).drop("k"))
    gap = is_gap(F.col("value"))
    gaps = rows.filter(gap).select(key, *group, "path", F.col("value").alias("original_value"))
    asked = gaps.select(*group, "path").distinct()
    better = F.struct((-F.length("value")).alias("less"), F.col(key).alias("source_key"), F.col("value").alias("filled_value"))
    best = (
        rows.filter(~gap)
        .join(asked, [*group, "path"], "left_semi")
        .groupBy(*group, "path")
        .agg(F.min(better).alias("best"), F.count("*").alias("sibling_count"))
    )
    status = F.when(F.col("best").isNull(), "skipped_no_sibling_value").otherwise("filled")
    return gaps.join(best, [*group, "path"], "left").select(
        key, "path", "original_value", "best.filled_value", "best.source_key", F.coalesce("sibling_count", F.lit(0)).alias("sibling_count"), status.alias("status")
    )


def enrich(df: DataFrame, key: str, doc: str, decisions: DataFrame) -> DataFrame:
    """key, doc: the documents with the decided fills."""
    return set_paths(df, key, doc, decisions.filter("status = 'filled'").select(key, "path", F.col("filled_value").alias("value")))


def differences(before: DataFrame, after: DataFrame, key: str, doc: str) -> DataFrame:
    """Leaves that differ between two states of documents: key, path, change (lost, added, changed), old, new."""
    old = walk(before, key, doc).select(key, "path", F.col("value").alias("old"))
    new = walk(after, key, doc).select(key, "path", F.col("value").alias("new"))
    change = F.when(F.col("new").isNull(), "lost").when(F.col("old").isNull(), "added").otherwise("changed")
    both = old.join(new, [key, "path"], "full").filter(~F.col("old").eqNullSafe(F.col("new")))
    return both.select(key, "path", change.alias("change"), "old", "new")
