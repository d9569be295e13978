"""SparkSession factory with the settings that every plan here assumes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: ANSI casts, UTC timestamps and runtime re-planning. Sizes of partitions are left to the cluster.
CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "tessera", **conf: str) -> SparkSession:
    """The active session, or a new one with CONF and the given extra settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in (CONF | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-stage-"))
    return sc._jsc.sc().getCheckpointDir().get()


def stage(df: DataFrame) -> DataFrame:
    """`df` written once as a table of the shared folder and read from there: computed once, and safe from lost executors."""
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
