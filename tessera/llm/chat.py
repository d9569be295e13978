"""Chat formatting with collapse of cumulative snapshots.

A logged conversation that is a prefix of a longer one adds nothing. Each turn gets a digest of its role and text before
any shuffle; within a conversation the digests are chained in order, each link the SHA-256 of the former link and the next
digest, which gives the rolling hash of every prefix. Two prefixes have one hash only if they have the same turns (or
SHA-256 has a collision). A conversation whose whole hash is among the proper prefixes is removed by an anti-join; the
prefixes are made distinct first, so a first turn that many conversations share is one row. Of equal conversations the
smallest conv_id stays. The rest is rendered.

A conversation is one row while its digests are chained (about 100 bytes a turn), and when it is rendered as one text: it
has to fit into a task.

Defined results: a row without conv_id is a conversation of its own, so that such rows never meet in one group. Turns
are ordered by turn (null first), then by digest. A null role renders as "unknown", a null text as empty. A backslash goes
between the characters of "<|" and, in roles, "|>"; where backslashes are between them already, one more does, so that no
turn mark can be forged and texts that differ render apart. A line feed in a role is a space. An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Links that one inner fold appends; arrays are copied as they grow, so long chains are folded block by block.
BLOCK = 256
ABSENT = "\x00"


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit(ABSENT)) for c in ("role", "text"))
    return conversations.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.sha2(F.concat(role, F.lit("\x01"), text), 256).alias("digest"),
    )


def _ordered(turns: DataFrame) -> DataFrame:
    return turns.withColumn("place", F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "digest")))


def _link(before: Column, digest: Column) -> Column:
    return F.sha2(F.concat(before, digest), 256)


def _chain(digests: Column) -> Column:
    """The rolling hash after each of the digests of one conversation."""

    def grow(state: Column, digest: Column) -> Column:
        link = _link(state["last"], digest)
        return F.struct(link.alias("last"), F.concat(state["links"], F.array(link)).alias("links"))

    def block(state: Column, start: Column) -> Column:
        empty = F.struct(state["last"].alias("last"), F.array().cast("array<string>").alias("links"))
        done = F.aggregate(F.slice(digests, start, F.lit(BLOCK)), empty, grow)
        return F.struct(done["last"].alias("last"), F.concat(state["blocks"], F.array(done["links"])).alias("blocks"))

    starts = F.sequence(F.lit(1), F.size(digests), F.lit(BLOCK))
    none = F.struct(F.lit("").alias("last"), F.array().cast("array<array<string>>").alias("blocks"))
    return F.flatten(F.aggregate(starts, none, block)["blocks"])


def _single(turns: DataFrame) -> DataFrame:
    """Turns without conv_id, each a conversation of one turn."""
    alone = turns.filter("conv_id IS NULL").withColumn("place", F.lit(1))
    return alone.withColumn("hash", _link(F.lit(""), F.col("digest")))


def _maximal(conversations: DataFrame) -> DataFrame:
    turns = _turns(conversations).select("conv_id", "turn", "digest")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest")))
    whole_turns = turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(ordered.alias("turns"))
    chained = whole_turns.select("conv_id", _chain(F.transform("turns", lambda t: t["digest"])).alias("links"))
    hashed = chained.select("conv_id", F.size("links").alias("n_turns"), F.posexplode("links").alias("before", "hash")).withColumn("place", F.col("before") + 1)
    key = ["place", "hash"]
    whole = (
        hashed.filter("place = n_turns")
        .select("conv_id", *key)
        .unionByName(_single(turns).select("conv_id", *key))
        .groupBy(*key)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    )
    prefixes = hashed.filter("place < n_turns").select(*key).distinct()
    return whole.join(prefixes, key, "left_anti")


def maximal(conversations: DataFrame) -> DataFrame:
    """The conversations that stay: conv_id, n_turns, n_equal (equal conversations, itself included)."""
    return _maximal(conversations).select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_equal")


def _turn_text() -> Column:
    role = F.regexp_replace(F.coalesce("role", F.lit("unknown")), r"<(\\*)\|", r"<\\$1|")
    role = F.translate(F.regexp_replace(role, r"\|(\\*)>", r"|\\$1>"), "\n", " ")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"<(\\*)\|", r"<\\$1|")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def render(conversations: DataFrame) -> DataFrame:
    """The maximal conversations as one text each: conv_id, n_turns, n_equal, text."""
    keep = _maximal(conversations).select(F.col("conv_id").alias("kept_id"), F.col("place").cast("long").alias("n_turns"), "n_equal", "hash")
    turns = _turns(conversations)
    shown = (
        _ordered(turns.filter("conv_id IS NOT NULL"))
        .join(keep.filter("kept_id IS NOT NULL").drop("hash"), F.col("conv_id") == F.col("kept_id"))
        .groupBy("conv_id", "n_turns", "n_equal")
        .agg(F.sort_array(F.collect_list(F.struct("place", _turn_text().alias("t")))).alias("turns"))
        .select("conv_id", "n_turns", "n_equal", F.array_join(F.transform("turns", lambda x: x["t"]), "").alias("text"))
    )
    single = _single(turns).groupBy("conv_id", "hash").agg(F.min(_turn_text()).alias("text"))
    alone = single.join(keep.filter("kept_id IS NULL"), "hash").select(single["conv_id"], "n_turns", "n_equal", "text")
    return shown.unionByName(alone)
