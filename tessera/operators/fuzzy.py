"""Fuzzy matching of names by edit ratios: joins that lose no match, and a waterfall of five tiers.

Candidates share a gram among the rarest ones of a name (prefix filter): of two names whose edit ratio reaches
`percent`, so many q-grams survive the edits that the rarest rest of either name must meet the other's. `percent` lies
above 100 - 100 / GRAM, so at least one gram always survives. Where the names are so alike that even their rarest grams
are frequent, joining grams costs more than comparing all pairs; then pairs are compared in blocks, first by bits of
their grams. Null and empty names match nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators.rank import first_of
from tessera.session import stage

GRAM = 3
#: Bits of a name's grams, in words of 64.
WORDS = 8
#: Pairs that are compared by their bits at the cost of one row of a gram join.
PAIRS_A_ROW = 8
#: Blocks that pairs are dealt into, more where these would have over BLOCK names of either side on average.
BLOCKS, BLOCK = 1000, 2048


def _names(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).filter(F.length(name) > 0).distinct()


def _grams(df: DataFrame, name: str, padding: int) -> DataFrame:
    """Rows (name, g), with the n-th equal gram of a name told apart from the first."""
    x = F.concat(F.lit("\0" * padding), F.col(name))
    every = F.transform(F.sequence(F.lit(1), F.length(x) - GRAM + 1), lambda i: F.substring(x, i, F.lit(GRAM)))
    rows = df.filter(F.length(x) >= GRAM).select(name, F.explode(every).alias("g"))
    counted = rows.groupBy(name, "g").agg(F.count("*").alias("n"))
    return counted.select(name, "g", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))


def _rarest(grams: DataFrame, known: DataFrame, name: str, most: Column) -> DataFrame:
    """The first `most` grams of each name, in the order of how often `known` holds them."""
    often = known.groupBy("g", "nth").agg(F.count("*").alias("often"))
    rows = grams.join(often, ["g", "nth"], "left").withColumn("often", F.coalesce("often", F.lit(0)))
    place = F.row_number().over(W.partitionBy(name).orderBy("often", "g", "nth"))
    return rows.withColumn("place", place).filter(F.col("place") <= most).select(name, "g", "nth")


def _distance(a: Column, b: Column, most: Column | None) -> Column:
    """The edit distance, or null where it is above `most`, which costs less to find."""
    if most is None:
        return F.levenshtein(a, b)
    found = F.call_function("levenshtein", a, b, most.cast("int"))
    return F.when(found >= 0, found)


def ratio(a: Column, b: Column, least: int | None = None) -> Column:
    """100 * (longer length - edit distance) / longer length, rounded down; with `least`, null below it."""
    longer = F.greatest(F.length(a), F.length(b))
    most = None if least is None else F.floor((100 - least) * longer / 100)
    return F.floor(100 * (longer - _distance(a, b, most)) / longer).cast("long")


def partial_ratio(a: Column, b: Column, least: int | None = None) -> Column:
    """The best ratio of the shorter text with any window of its length in the other; with `least`, null below it."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    starts = F.sequence(F.lit(1), F.length(long) - F.length(short) + 1)
    return F.array_max(F.transform(starts, lambda i: ratio(short, F.substring(long, i, F.length(short)), least)))


def _all_grams(x: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - GRAM + 1), lambda i: F.substring(x, i, F.lit(GRAM))))


def _bits(df: DataFrame, name: str, padding: int) -> DataFrame:
    """`df` with the words of a name's bits; each distinct gram sets one, so a lost bit is a lost gram."""

    def word(k: int) -> Column:
        def mark(s: Column, g: Column) -> Column:
            h = F.pmod(F.xxhash64(g), F.lit(64 * WORDS))
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), (h % 64).cast("int"))
            return s.bitwiseOR(F.when((h >= 64 * k) & (h < 64 * k + 64), bit).otherwise(F.lit(0).cast("long")))

        return F.aggregate(_all_grams(F.concat(F.lit("\0" * padding), F.col(name))), F.lit(0).cast("long"), mark)

    return df.select(name, *[word(k).alias(f"{name}{k}") for k in range(WORDS)])


def _lost(own: str, other: str) -> Column:
    """Bits of one name that the other lacks."""
    return sum((F.bit_count(F.col(f"{own}{k}").bitwiseAND(F.bitwise_not(F.col(f"{other}{k}")))) for k in range(WORDS)), F.lit(0))


def _all_pairs(x: DataFrame, n_x: int, y: DataFrame, n_y: int) -> DataFrame:
    """All pairs of the rows of x (a) and y (b), in blocks dealt to tasks."""
    size = min(BLOCK, math.isqrt(n_x * n_y // BLOCKS) + 1)
    p, q = max(1, -(-n_x // size)), max(1, -(-n_y // size))

    def dealt(df: DataFrame, name: str, own: str, parts: int, other: str, others: int) -> DataFrame:
        own_block = F.pmod(F.xxhash64(name), F.lit(parts)).cast("int").alias(own)
        # As many tasks as blocks: by their bytes, which say nothing of the work, blocks would be put together.
        return df.select("*", own_block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)).repartition(min(p * q, 10_000), "_i", "_j")

    return dealt(x, "a", "_i", p, "_j", q).join(dealt(y, "b", "_j", q, "_i", p).hint("shuffle_hash"), ["_i", "_j"]).drop("_i", "_j")


def _joined_rows(x: DataFrame, y: DataFrame, keys: list[str]) -> int:
    """The rows of an equi-join."""
    n_x, n_y = (side.groupBy(*keys).agg(F.count("*").alias(n)) for side, n in ((x, "n_x"), (y, "n_y")))
    return n_x.join(n_y, keys).agg(F.coalesce(F.sum(F.col("n_x") * F.col("n_y")), F.lit(0))).first()[0]


def ratio_join(left: DataFrame, right: DataFrame, a: str, b: str, percent: int) -> DataFrame:
    """Pairs of distinct names whose ratio is at least `percent`: a, b, score. Raises ValueError for a percent at which no
    gram need survive; passjoin.ratio_join takes any."""
    if GRAM * (100 - percent) >= 100:
        raise ValueError(f"edits at {percent} % can leave no gram")
    names_x, names_y = stage(_names(left, a, "a")), stage(_names(right, b, "b"))
    x, y = stage(_grams(names_x, "a", GRAM - 1)), stage(_grams(names_y, "b", GRAM - 1))

    def most(name: str) -> Column:
        return F.length(name) - F.ceil((100 - GRAM * (100 - percent)) * F.length(name) / 100) + 1

    near = 100 * F.abs(F.length("a") - F.length("b")) <= (100 - percent) * F.greatest(F.length("a"), F.length("b"))
    x, y, n_x, n_y = stage(_rarest(x, y, "a", most("a"))), stage(_rarest(y, y, "b", most("b"))), names_x.count(), names_y.count()
    if PAIRS_A_ROW * _joined_rows(x, y, ["g", "nth"]) < n_x * n_y:
        pairs = x.join(y, ["g", "nth"]).filter(near).select("a", "b").distinct()
    else:
        # An edit takes at most GRAM grams of either name away.
        taken = GRAM * F.floor((100 - percent) * F.greatest(F.length("a"), F.length("b")) / 100)
        pairs = _all_pairs(_bits(names_x, "a", GRAM - 1), n_x, _bits(names_y, "b", GRAM - 1), n_y)
        pairs = pairs.filter(near).filter(_lost("a", "b") <= taken).filter(_lost("b", "a") <= taken).select("a", "b")
    return pairs.withColumn("score", ratio(F.col("a"), F.col("b"), percent)).filter(F.col("score") >= percent)


def partial_join(left: DataFrame, right: DataFrame, a: str, b: str, percent: int, least: int = GRAM) -> DataFrame:
    """Pairs of distinct names whose partial_ratio is at least `percent`, the shorter one of `least` characters or more
    (at least GRAM): a, b, score. Raises ValueError where edits could leave no gram of so short a name."""
    if least < GRAM or (100 - GRAM * (100 - percent)) * least <= 100 * (GRAM - 1):
        raise ValueError(f"names of {least} characters are too short for a partial ratio of {percent}")
    names_x, names_y = (stage(_names(side, column, name).filter(F.length(name) >= least)) for side, column, name in ((left, a, "a"), (right, b, "b")))
    x, y = stage(_grams(names_x, "a", 0)), stage(_grams(names_y, "b", 0))

    def most(name: str) -> Column:
        return F.length(name) - GRAM + 1 - F.ceil((100 - GRAM * (100 - percent)) * F.length(name) / 100 - (GRAM - 1)) + 1

    # A gram may stand at another place among its equals in the longer name, so only the grams themselves are joined.
    rare_x, rare_y, n_x, n_y = stage(_rarest(x, y, "a", most("a"))), stage(_rarest(y, y, "b", most("b"))), names_x.count(), names_y.count()
    # An edit takes at most GRAM grams away, so the longer name has all but so many of the shorter one's.
    shorter = F.least(F.length("a"), F.length("b"))
    taken = GRAM * F.floor((100 - percent) * shorter / 100)
    if PAIRS_A_ROW * (_joined_rows(rare_x, y, ["g"]) + _joined_rows(x, rare_y, ["g"])) < n_x * n_y:
        inside = rare_x.join(y, "g").filter(F.length("a") <= F.length("b")).select("a", "b")
        around = x.join(rare_y, "g").filter(F.length("a") > F.length("b")).select("a", "b")
        in_a, in_b = _all_grams(F.col("a")), _all_grams(F.col("b"))
        lost = F.when(F.length("a") <= F.length("b"), F.size(F.array_except(in_a, in_b))).otherwise(F.size(F.array_except(in_b, in_a)))
        pairs = inside.unionByName(around).distinct().filter(lost <= taken)
    else:
        pairs = _all_pairs(_bits(names_x, "a", 0), n_x, _bits(names_y, "b", 0), n_y)
        pairs = pairs.filter(F.when(F.length("a") <= F.length("b"), _lost("a", "b")).otherwise(_lost("b", "a")) <= taken).select("a", "b")
    # With its gaps around, a window of so few edits is an alignment of the whole names.
    edits = F.floor((100 - percent) * shorter / 100)
    whole = F.call_function("levenshtein", F.col("a"), F.col("b"), (F.abs(F.length("a") - F.length("b")) + edits).cast("int"))
    pairs = pairs.filter(whole >= 0)
    return pairs.withColumn("score", partial_ratio(F.col("a"), F.col("b"), percent)).filter(F.col("score") >= percent)


def five_tiers(names: DataFrame, known: DataFrame, name: str, title: str, ident: str) -> DataFrame:
    """The best match of each distinct name: name, step, ident, title, score.

    Tiers: 1 what stands in parentheses; 2 a ratio of 95 or more, refused where both end in different variants
    ("2a", "2b"); 3 a token of six characters or more; 4 a ratio of 85 or more; 5 a partial ratio of 90 or more.
    Within a tier the highest score wins, then the shortest title, then the least. Titles are distinct and in lower case.
    Distinct names, titles and their grams are staged, so each table is read once; only names that the first four tiers
    leave open go to the last.
    """
    wanted = stage(names.select(name).filter(F.col(name).isNotNull()).distinct().withColumn("_k", F.lower(F.trim(name))))
    titles = stage(known.select(title, ident))

    def exact(keys: DataFrame, step: int) -> DataFrame:
        return keys.join(titles, F.col("_t") == F.col(title)).select(name, F.lit(step).alias("step"), title, ident, F.lit(100).cast("long").alias("score"))

    def scored(pairs: DataFrame, step: Column) -> DataFrame:
        hit = wanted.join(pairs, F.col("_k") == F.col("a")).join(titles, F.col("b") == F.col(title))
        return hit.select(name, step.alias("step"), title, ident, "score")

    inner = exact(wanted.select(name, F.lower(F.trim(text.parenthetical(F.col(name)))).alias("_t")), 1)
    token = exact(wanted.select(name, F.explode(text.long_tokens(F.col("_k"))).alias("_t")), 3)
    near = scored(stage(ratio_join(wanted, titles, "_k", title, 85)), F.when(F.col("score") >= 95, 2).otherwise(4))
    order = [F.desc("score"), F.length(title), F.col(title)]
    first = first_of(inner.unionByName(token).unionByName(near), [name, "step"], order)
    mine, other = text.variant_suffix(F.col(name)), text.variant_suffix(F.col(title))
    first = first.filter(~((F.col("step") == 2) & (mine != "") & (other != "") & (mine != other)))
    best = stage(first_of(first, [name], [F.col("step")]))
    rest = stage(wanted.join(best.select(name), name, "left_anti"))
    pairs = partial_join(rest, titles, "_k", title, 90)
    last = rest.join(pairs, F.col("_k") == F.col("a")).join(titles, F.col("b") == F.col(title))
    last = first_of(last.select(name, F.lit(5).alias("step"), title, ident, "score"), [name], order)
    return best.unionByName(last)
