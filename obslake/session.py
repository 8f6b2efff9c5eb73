"""Session settings the lake relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_FILE_BYTES = 300 * 1024 * 1024

# Raw biogeochemical tables have 219 columns. Past spark.sql.codegen.maxFields (100 by
# default) Spark drops both whole-stage codegen and columnar Parquet batches.
#
# The JVM never compiles a method above 8000 bytes of bytecode. A stage as long as the best
# values of 30 parameters, or the seawater polynomials, fuses into one such method and then
# runs interpreted, about ten times slower. With the limit below Spark runs the operators
# of such a stage one by one instead, each with generated code small enough to compile.
LAKE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A side is broadcast by its size in bytes only, planned or, with the setting below, measured.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "obslake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the lake's settings; ``settings`` override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LAKE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the lake's settings on a session somebody else has built."""
    for key, value in LAKE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Where that setting is absent the context's checkpoint folder serves, and where there is
    none either it is an error: a machine-local folder would lose rows on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, whatever follows."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
