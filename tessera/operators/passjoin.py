"""Edit-distance joins by segments.

A string cut into t + 1 segments keeps one of them whole under t edits, at a place shifted by so few positions that the
segments before and behind can take the rest of the edits. The longer string of a pair is cut, as evenly as can be, and
listed under (length, segment, text); the shorter one looks up its substrings of the same sizes at the possible places.
No pair within t edits is lost, however small the ratio. Hot segments are left to the skew join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits allowed for a pair whose longer string has so many characters.
Allowed = Callable[[Column], Column]


def by_percent(percent: int) -> Allowed:
    """Edits that leave 100 * (1 - edits / length) at `percent` or more."""
    return lambda n: F.floor(n * (100 - percent) / 100).cast("int")


def at_most(edits: int) -> Allowed:
    return lambda n: F.lit(edits)


def _segment(n: Column, parts: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 1) and size of segment i (from 0) of a string of n characters in so many parts; longer ones come last."""
    size = F.floor(n / parts).cast("int")
    short = parts - n % parts
    return i * size + F.greatest(i - short, F.lit(0)) + 1, size + (i >= short).cast("int")


def _key(n: Column, i: Column, part: Column) -> Column:
    return F.xxhash64(n, i, part)


def _listed(x: Column, allowed: Allowed) -> Column:
    n = F.length(x)
    parts = allowed(n) + 1

    def one(i: Column) -> Column:
        start, size = _segment(n, parts, i)
        return _key(n, i, F.substring(x, start, size))

    return F.array_distinct(F.transform(F.sequence(F.lit(0), parts - 1), one))


def _looked_up(x: Column, allowed: Allowed, longest: Column, least: int) -> Column:
    """Keys for all lengths from that of x (plus `least`) to `longest`."""
    a = F.length(x)
    none = F.array().cast("array<bigint>")

    def length(n: Column) -> Column:
        edits = allowed(n)
        shift = a - n  # not positive

        def segment(i: Column) -> Column:
            start, size = _segment(n, edits + 1, i)
            lo = F.greatest(F.lit(1), start - i, start + shift - (edits - i))
            hi = F.least(a - size + 1, start + i, start + shift + (edits - i))
            places = F.transform(F.sequence(lo, F.greatest(lo, hi)), lambda s: _key(n, i, F.substring(x, s, size)))
            return F.when(lo <= hi, places).otherwise(none)

        keys = F.flatten(F.transform(F.sequence(F.lit(0), edits), segment))
        return F.when(edits >= n - a, keys).otherwise(none)

    lengths = F.sequence(a + least, F.greatest(a + least, longest))
    return F.array_distinct(F.flatten(F.transform(lengths, length)))


def edit_pairs(left: DataFrame, right: DataFrame, a: str, b: str, allowed: Allowed, most_longer: Callable[[Column], Column]) -> DataFrame:
    """Pairs of distinct values within the edits that the longer one allows: a, b, distance.

    `most_longer` bounds the length of a partner by that of the shorter string. Nulls and empty strings meet nothing.
    """
    x = left.select(F.col(a).alias("a")).filter(F.length(a) > 0).distinct()
    y = right.select(F.col(b).alias("b")).filter(F.length(b) > 0).distinct()

    def looks(df: DataFrame, c: str, least: int) -> DataFrame:
        return df.select(c, F.explode(_looked_up(F.col(c), allowed, most_longer(F.length(c)), least)).alias("k"))

    def lists(df: DataFrame, c: str) -> DataFrame:
        return df.select(c, F.explode(_listed(F.col(c), allowed)).alias("k"))

    pairs = looks(x, "a", 0).join(lists(y, "b"), "k").select("a", "b")
    pairs = pairs.unionByName(looks(y, "b", 1).join(lists(x, "a"), "k").select("a", "b")).distinct()
    scored = pairs.withColumn("distance", F.levenshtein("a", "b").cast("long"))
    return scored.filter(F.col("distance") <= allowed(F.greatest(F.length("a"), F.length("b"))))


def edit_join(left: DataFrame, right: DataFrame, a: str, b: str, most: int) -> DataFrame:
    """Pairs of values at an edit distance of at most `most`: a, b, distance."""
    return edit_pairs(left, right, a, b, at_most(most), lambda n: n + most)


def ratio_join(left: DataFrame, right: DataFrame, a: str, b: str, percent: int) -> DataFrame:
    """Pairs of values of which 100 * (1 - distance / longer length) is `percent` (above 0) or more: a, b, distance, ratio."""
    pairs = edit_pairs(left, right, a, b, by_percent(percent), lambda n: F.floor(n * 100 / percent).cast("int"))
    longest = F.greatest(F.length("a"), F.length("b"))
    return pairs.withColumn("ratio", 100 * (1 - F.col("distance") / longest))
