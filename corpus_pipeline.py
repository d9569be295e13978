"""Preparation of a training corpus: quality rules, exact dedup, n-gram Jaccard join, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, jaccard_join, mixing, pieces, quality_rules
from tessera.llm.common import stage_table

#: Near copies: the share of common shingles (in per cent) and the words of a shingle. op5's values are its own.
NEAR_PERCENT = 80
NEAR_WIDTH = 5


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.filter_rows(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.keep_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links join, the one with the least doc_id stays."""
    return jaccard_join.keep_rows(docs, percent=NEAR_PERCENT, width=NEAR_WIDTH)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for each time that the mix takes them; those that it never takes go.

    The last document of a source's target is cut to the words that the mix takes of it.
    """
    return mixing.mix_rows(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's best segmentations into pieces, with their ids."""
    return _encoded(docs)


def _encoded(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=carry)


STAGES = [
    ("quality rules", rules),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixture),
    ("SentencePiece encoding", encoding),
]

#: The last stage's search over pieces is not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; the result is in training order.

    A stored table may be read in another order, so the order goes through the last two stages as a column.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-2]:
        docs = stage_table(stage(spark, docs, sf_dir))
    docs = stage_table(mixing.mix_rows(docs, order="training_order"))
    return stage_table(_encoded(docs, carry=("training_order",))).orderBy("training_order").drop("training_order")
