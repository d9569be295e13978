"""Mixing sources to target weights over a time-varying curriculum.

Shares. Sources ordered by code point (null last) weigh `weights`, repeating, and share all words; no source is
taken more than `max_repeats` times. What capped sources cannot take is shared by weight among the others: with
sources ordered by cap / weight, the common level follows from two running sums, without iteration.

Order. A source's documents follow each other in the order of an MD5 key, pass after pass, until the target is
used up; the last one may be cut. Their starts are running word sums in two levels (sums of key buckets, then
sums within a bucket), so that a hot source is spread over `16 ** key_digits` groups.

Time. A source's weight schedule is piecewise linear over training time 0 to 1. Its integral is the share of the
source's demand that time t has used; inverting it at a document's start gives the document's training position.
`stream` range-sorts the takes by position.

Sizes, sums and keys are exact and seeded, so reruns agree. Defined results: a null text has size 0; texts of
size 0 are never taken; without words all targets are 0. Null doc_ids and repeated rows are ordered by key, doc_id
and size, so equal rows are interchangeable. Further columns are ignored, or kept as one struct by `carry`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import first_words, text_of, words_of

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
KEY_DIGITS = 3

#: Knots (time, relative weight) of the schedules, given to the sources in turn: steady, rising, falling.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
)


def position_at(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the schedule's integral reaches `share` (0 to 1) of its whole."""
    pieces = [(t0, t1, w0, w1, (t1 - t0) * (w0 + w1) / 2) for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole = sum(p[4] for p in pieces)
    found, before = None, 0.0
    for t0, t1, w0, w1, area in pieces:
        rest = share * whole - before
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * rest))
        time = F.least(F.lit(t1), t0 + F.try_divide(2 * rest, w0 + root))
        before += area
        cond = share * whole <= F.lit(before)
        found = F.when(cond, time) if found is None else found.when(cond, time)
    return found.otherwise(F.lit(knots[-1][0]))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of sources; `sizes` has one row for each source: no_source, source_key, source_size.

    Windows over one partition hold one row for each source, not for each document.
    """
    by_name = W.orderBy("no_source", "source_key")
    ranked = sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("long"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("double")).withColumn(
        "cap", (F.col("source_size") * max_repeats).cast("double")
    )
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = ranked.select(
        "*",
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)).alias("open_weight"),
        F.row_number().over(by_ratio).alias("nth"),
    ).withColumn("is_open", F.col("cap") * F.col("open_weight") > F.col("weight") * (F.col("total") - F.col("capped")))
    first = F.min(F.when(F.col("is_open"), F.struct("nth", "total", "capped", "open_weight"))).over(everything)
    return (
        levels.withColumn("first", first)
        .withColumn(
            "target",
            F.when(
                F.col("nth") >= F.col("first.nth"),
                F.col("weight") * (F.col("first.total") - F.col("first.capped")) / F.col("first.open_weight"),
            ).otherwise(F.col("cap")),
        )
        .select("no_source", "source_key", "source_size", "rank", "target")
    )


def assign(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    schedules=SCHEDULES,
    seed: str = "mix",
    key_digits: int = KEY_DIGITS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Each row's part in the mix: doc_id, source, size, source_size, target, taken, takes.

    takes: at most `max_repeats` structs (pass, position, words). `carry` names columns to return as `carried`.
    """
    # Rows without doc_id are spread by their texts.
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(text_of()))
    key = F.md5(F.concat(F.lit(f"{seed}:"), own))
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.size(words_of(text_of())).cast("long").alias("size"),
        key.alias("key"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []),
    ).select(
        "*",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        F.substring("key", 1, key_digits).alias("bucket"),
    )
    group = ["no_source", "source_key"]
    sums = rows.groupBy(*group, "bucket").agg(F.sum("size").alias("bucket_size"))
    before = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0).cast("long")))
    targets = source_targets(sums.groupBy(*group).agg(F.sum("bucket_size").alias("source_size")), weights, max_repeats)
    within = W.partitionBy(*group, "bucket").orderBy("key", "doc_id", "size")
    placed = (
        rows.withColumn("so_far", F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)))
        .join(offsets.join(targets, group).drop("bucket_size"), [*group, "bucket"])
        .withColumn("start", F.col("offset") + F.col("so_far") - F.col("size"))
        .withColumn("quota", F.floor(F.col("target") + 0.5))
    )
    passes = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(max_repeats - 1)),
            lambda p: F.struct(p.alias("pass"), (p * F.col("source_size") + F.col("start")).alias("start")),
        ),
        lambda x: (x["start"] < F.col("quota")) & (F.col("size") > 0),
    )

    def when_at(share: Column) -> Column:
        which = F.col("rank") % len(schedules)
        out = F.when(which == 0, position_at(share, schedules[0]))
        for k, knots in enumerate(schedules[1:], 1):
            out = out.when(which == k, position_at(share, knots))
        return out

    takes = F.transform(
        passes,
        lambda x: F.struct(
            x["pass"].alias("pass"),
            when_at(x["start"] / F.col("quota")).alias("position"),
            F.least(F.col("size"), F.col("quota") - x["start"]).alias("words"),
        ),
    )
    return placed.withColumn("takes", takes).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate("takes", F.lit(0).cast("long"), lambda n, x: n + x["words"]).alias("taken"),
        "takes",
        *(["carried"] if carry else []),
    )


def stream(assigned: DataFrame) -> DataFrame:
    """One row for each take, range-sorted by training position."""
    return (
        assigned.select("*", F.explode("takes").alias("take"))
        .drop("takes")
        .select("*", "take.*")
        .drop("take")
        .orderBy("position", "source", "doc_id", "pass")
    )


def mix_rows(docs: DataFrame, order: str | None = None, **options) -> DataFrame:
    """The rows of `docs` in training order, with all their columns, once for each time that the mix takes them.

    A take of fewer words than its document has keeps those words only; a column n_chars then counts what is left.
    `order` names a further column to sort by, which stays right where rows are stored and read in another order.
    """
    taken = stream(assign(docs, carry=tuple(docs.columns), **options))
    is_cut = F.col("words") < F.col("size")
    text = F.when(is_cut, first_words(F.col("carried")["text"], F.col("words"))).otherwise(F.col("carried")["text"])
    taken = taken.withColumn("text", text)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(is_cut, length).otherwise(F.col("carried")["n_chars"])
    columns = [changed.get(c, F.col("carried")[c]).alias(c) for c in docs.columns]
    return taken.select(*columns, *([F.struct("position", "source", "doc_id", "pass").alias(order)] if order else []))
