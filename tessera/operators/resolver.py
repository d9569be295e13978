"""Resolution of names by tiers with early return: a name that a tier knows does not reach the next, dearer one.

Relations, all with names as they are written: brands (brand_id, brand, id; id may be null), ingredients (brand_id, id),
entities (id, name, other_names array, plain_name) and synonyms (synonym, id). Comparison ignores case. The first tier
that has rows for a name gives all of them, so that a combination gives several; fuzzy tiers give three at most.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators.rank import first_of
from tessera.operators.similarity import trigram_join
from tessera.session import stage

FUZZY_ROWS = 3
#: A name with more pairs of asking and resolved rows than SIDE * SIDE is joined in blocks of about SIDE rows of either.
SIDE = 1024
COLUMNS = "name string, step int, match_type string, id long, matched string"


@dataclass(frozen=True)
class Relations:
    brands: DataFrame
    ingredients: DataFrame
    entities: DataFrame
    synonyms: DataFrame


@dataclass(frozen=True)
class Tier:
    """`find` gives rows name, id, matched for open names (name, up: the name in capital letters)."""

    label: str
    find: Callable[[DataFrame, Relations], DataFrame]


def _equal(open_names: DataFrame, known: DataFrame, key: str, matched: str) -> DataFrame:
    keyed = known.withColumn("up", F.upper(key))
    return open_names.join(keyed, "up").select("name", "id", F.col(matched).alias("matched"))


def _brand_exact(names: DataFrame, r: Relations) -> DataFrame:
    return _equal(names, r.brands.filter("id IS NOT NULL"), "brand", "brand")


def _combination(names: DataFrame, r: Relations) -> DataFrame:
    parts = r.brands.select("brand_id", "brand").join(r.ingredients.filter("id IS NOT NULL"), "brand_id")
    return _equal(names, parts, "brand", "brand")


def _entity(names: DataFrame, r: Relations) -> DataFrame:
    own = r.entities.select("id", "name", F.upper("name").alias("key"))
    other = r.entities.select("id", "name", F.explode("other_names").alias("key"))
    known = own.unionByName(other).select("id", F.col("name").alias("matched"), F.upper("key").alias("up")).distinct()
    return names.join(known, "up").select("name", "id", "matched")


def _plain(names: DataFrame, r: Relations) -> DataFrame:
    stripped = names.withColumn("up", text.strip_suffix(F.col("name"), text.SALTS, plural=False))
    known = r.entities.select("id", F.col("name").alias("matched"), F.col("plain_name").alias("up"))
    return stripped.join(known, "up").select("name", "id", "matched")


def _synonym(names: DataFrame, r: Relations) -> DataFrame:
    return _equal(names, r.synonyms.filter("id IS NOT NULL"), "synonym", "synonym").distinct()


def _similar(names: DataFrame, known: DataFrame, above: float) -> DataFrame:
    """The FUZZY_ROWS most similar rows of `known` (id, matched), then the least matched, then the least id."""
    pairs = trigram_join(names, known.select(F.upper("matched").alias("upper")), "up", "upper", above).filter(F.col("similarity") > above)
    hits = names.join(pairs, F.col("up") == F.col("a")).join(known, F.col("b") == F.upper("matched"))
    return first_of(hits.select("name", "id", "matched", "similarity").distinct(), ["name"], [F.col("similarity").desc(), F.col("matched"), F.col("id")], FUZZY_ROWS).drop("similarity")


def _fuzzy_brand(names: DataFrame, r: Relations) -> DataFrame:
    return _similar(names, r.brands.filter("id IS NOT NULL").select("id", F.col("brand").alias("matched")), 0.6)


def _fuzzy_entity(names: DataFrame, r: Relations) -> DataFrame:
    return _similar(names, r.entities.select("id", F.col("name").alias("matched")), 0.5)


def _fuzzy_synonym(names: DataFrame, r: Relations) -> DataFrame:
    return _similar(names, r.synonyms.filter("id IS NOT NULL").select("id", F.col("synonym").alias("matched")).distinct(), 0.5)


def _fuzzy_any(names: DataFrame, r: Relations) -> DataFrame:
    own = r.entities.select("id", F.col("name").alias("matched"))
    other = r.entities.select("id", F.explode("other_names").alias("matched"))
    known = own.unionByName(other).unionByName(r.synonyms.filter("id IS NOT NULL").select("id", F.col("synonym").alias("matched")))
    return _similar(names, known.distinct(), 0.6)


_FIRST = (Tier("brand_exact", _brand_exact), Tier("combination", _combination), Tier("entity", _entity), Tier("plain_entity", _plain))
_FUZZY = (Tier("fuzzy_brand", _fuzzy_brand), Tier("fuzzy_entity", _fuzzy_entity))
_SYNONYM = Tier("synonym", _synonym)
#: Orders of tiers: the plain one, the one with synonyms, and the one for names in questions.
SIX = (*_FIRST, *_FUZZY)
EIGHT = (*_FIRST, _SYNONYM, *_FUZZY, Tier("fuzzy_synonym", _fuzzy_synonym))
QUESTIONS = (Tier("entity", _entity), _SYNONYM, Tier("fuzzy_any", _fuzzy_any))


def resolve(names: DataFrame, relations: Relations, tiers: tuple[Tier, ...] = SIX) -> DataFrame:
    """Rows name, step, match_type, id, matched for each distinct name (column `name`) that a tier knows.

    Each tier's rows are staged, and only names without any go on. Null names are left out; the rest of the names are
    those that the result lacks.
    """
    open_names = stage(names.select("name").filter("name IS NOT NULL").distinct().withColumn("up", F.upper("name")))
    out = names.sparkSession.createDataFrame([], COLUMNS)
    for step, tier in enumerate(tiers, 1):
        rows = tier.find(open_names, relations).select("name", F.lit(step).alias("step"), F.lit(tier.label).alias("match_type"), F.col("id").cast("long").alias("id"), "matched")
        rows = stage(rows)
        out = out.unionByName(rows)
        if step < len(tiers):
            open_names = stage(open_names.join(rows.select("name").distinct(), "name", "left_anti"))
            if open_names.isEmpty():
                break
    return out


class FirstTier:
    """A table function over candidates of one name in order of tiers: all rows of the first tier, or its first few.

    To be called with PARTITION BY the name and ORDER BY step and place; only the current row is held.
    """

    def __init__(self):
        self.step, self.rows = None, 0

    def eval(self, row, most: int):
        if self.step is None:
            self.step = row["step"]
        if row["step"] == self.step and (most <= 0 or self.rows < most):
            self.rows += 1
            yield row["name"], row["step"], row["match_type"], row["id"], row["matched"]


def register(spark: SparkSession, resolved: DataFrame) -> None:
    """Registers table functions for SQL: first_tier(TABLE ..., most), and resolve_name(name) over rows of `resolve`.

    resolve_name is a SQL function, so that Catalyst turns a lateral join with it into a plain join on the name.
    """
    from pyspark.sql.functions import udtf

    spark.udtf.register("first_tier", udtf(FirstTier, returnType=COLUMNS))
    resolved.createOrReplaceTempView("_resolved_names")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION resolve_name(input STRING) "
        "RETURNS TABLE(step INT, match_type STRING, id BIGINT, matched STRING) "
        "RETURN SELECT r.step, r.match_type, r.id, r.matched FROM _resolved_names r WHERE r.name = input"
    )


def look_up(asked: DataFrame, resolved: DataFrame, side: int = SIDE) -> DataFrame:
    """Each row of `asked` (with a column `name`) with step, match_type, id and matched of resolve_name(name), or nulls.

    A name that asks often and has many rows would give its product in one task. Both of its sides are dealt into blocks,
    and each pair of blocks is a key of its own for resolve_block, the same function over blocks.
    """
    spark, asked = asked.sparkSession, stage(asked)
    n_x, n_y = (df.groupBy("name").agg(F.count("*").alias(n)) for df, n in ((asked, "n_x"), (resolved, "n_y")))
    parts = [F.ceil(F.col(n) / side).cast("int").alias(p) for n, p in (("n_x", "p"), ("n_y", "q"))]
    hot = stage(n_x.join(n_y, "name").filter(F.col("n_x") * F.col("n_y") > side * side).select("name", *parts))
    register(spark, resolved)
    blocks = hot.agg(F.sum(F.col("p").cast("long") * F.col("q"))).first()[0]
    if not blocks:
        return spark.sql("SELECT w.*, r.* FROM {asked} w LEFT JOIN LATERAL resolve_name(w.name) r", asked=asked)

    def dealt(df: DataFrame, own: str, parts: str, other: str, others: str) -> DataFrame:
        block = F.pmod(F.xxhash64(*df.columns), F.col(parts)).cast("int").alias(own)
        rows = df.join(hot, "name").select(*df.columns, block, F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other))
        # A number of its own: by their bytes, which say nothing of their products, blocks would be put together.
        return rows.repartition(min(blocks, 2000), "name", "_i", "_j")

    dealt(resolved, "_j", "q", "_i", "p").createOrReplaceTempView("_resolved_blocks")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION resolve_block(input STRING, i INT, j INT) "
        "RETURNS TABLE(step INT, match_type STRING, id BIGINT, matched STRING) "
        "RETURN SELECT r.step, r.match_type, r.id, r.matched FROM _resolved_blocks r WHERE r.name = input AND r._i = i AND r._j = j"
    )
    rest = asked.join(hot, "name", "left_anti").select(asked.columns)
    light = spark.sql("SELECT w.*, r.* FROM {rest} w LEFT JOIN LATERAL resolve_name(w.name) r", rest=rest)
    heavy = dealt(asked, "_i", "p", "_j", "q")
    heavy = spark.sql("SELECT w.*, r.* FROM {heavy} w JOIN LATERAL resolve_block(w.name, w._i, w._j) r", heavy=heavy)
    return light.unionByName(heavy.drop("_i", "_j"))
