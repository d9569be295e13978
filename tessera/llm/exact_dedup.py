"""Exact dedup by skew-safe combining.

1. Locally: rows are grouped by (digest, salt, text) with map-side partial aggregation, so a task sends one row
   for all its copies of a text and salt.
2. Salted groups: a group of copies of any size is spread over `salts` reducers.
3. Globally: at most `salts` winners of a text meet and are combined by (digest, text).

The text itself is part of the grouping key at every stage, so equal digests alone never merge two texts. The
winners then go back to the rows by digest alone where the digest names one text (always, for SHA-256), and by
digest and text for digests that name several. Sort-merge joins leave hot digests to the skew join.

Defined results: a null text equals the empty text. Of equal rows the largest doc_id stays; a null doc_id is
less than any other. Rows that repeat the winning doc_id are all marked as kept, since nothing tells them
apart; `keep_rows` returns one of them. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, text_of

SALTS = 16


def sha256(text: Column) -> Column:
    """SHA-256 of the UTF-8 text, as bytes."""
    return F.unhex(F.sha2(text, 256))


def _hashed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "digest", digest(F.col("text"))
    )


def winners(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row for each distinct text: digest, text, keep_id, group_size."""
    salted = (
        _hashed(docs, digest)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    )
    return salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def mark(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Each row's group: doc_id, keep_id, group_size, kept, digest (bytes)."""
    won = winners(docs, salts, digest)
    # Digests and numbers only: the texts are shuffled twice, and the lineage is cut behind them.
    by_digest = cut(
        won.groupBy("digest").agg(
            F.count("*").alias("n_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        )
    )
    rows = _hashed(docs, digest)
    marked = rows.drop("text").join(by_digest.filter("n_texts = 1").drop("n_texts"), "digest")
    shared = by_digest.filter("n_texts > 1").select("digest")
    if not shared.isEmpty():
        clash = rows.join(shared, "digest", "left_semi").join(won, ["digest", "text"])
        marked = marked.unionByName(clash.drop("text"))
    return marked.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def keep_rows(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: for each text the row with the largest doc_id.

    The same three stages, carrying the winning row (the greatest doc_id, then the greatest hash of its other columns,
    which may be of any type) along.
    """
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    packed = docs.select(
        text_of().alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(row.alias("row"), F.col("text").isNull().alias("none")).alias("whole"),
        F.sha2(F.to_json(row), 256).alias("tie"),
    ).select("text", "whole", F.struct("doc_id", "tie").alias("rank"), sha256(F.col("text")).alias("digest"))
    winner = F.max_by("whole", "rank").alias("whole")
    salted = (
        packed.withColumn("salt", F.pmod(F.xxhash64("rank.doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "text")
        .agg(F.max("rank").alias("rank"), winner)
    )
    kept = salted.groupBy("digest", "text").agg(winner)
    text = F.when(~F.col("whole.none"), F.col("text")).alias("text")
    return kept.select(*[text if c == "text" else F.col("whole.row")[c].alias(c) for c in docs.columns])
