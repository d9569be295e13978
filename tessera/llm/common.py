"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the space and U+0009 to U+000D.
BLANKS = "[\\x20\\x09-\\x0D]+"


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text that is not null, in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word (n >= 1), as it is written."""
    parts = F.split(text, "(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])")
    lead = text.rlike("^[\\x20\\x09-\\x0D]").cast("int")
    return F.rtrim(F.array_join(F.slice(parts, F.lit(1), (n + lead).cast("int")), ""), F.lit(" \t\n\x0b\x0c\r"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with `value` computed once however often `body` uses it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where none is set, a local session takes a new temporary one; on a
    cluster that is an error, since its machines share no temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder, its lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared checkpoint folder, read back; its lineage is cut."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few bytes that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def if_few(ids: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`ids` (stored, rows of a few bytes) marked for broadcast where they are few; else left to a shuffle join."""
    return F.broadcast(ids) if ids.count() <= most else ids
