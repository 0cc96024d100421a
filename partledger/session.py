"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Counts by partition are then taken from footers.
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A union of joins would otherwise claim their partitioning, and a join above it fails
    # once adaptive execution coalesces the two inputs differently.
    "spark.sql.unionOutputPartitioning": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the library's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared directory named by ``spark.checkpoint.dir``.

    A cluster must name one: each machine would write to its own disk otherwise. In a local
    session, where there is one disk, a temporary folder stands in for an absent setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/partledger-{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts lineage and keeps a result that several later steps use from being computed again;
    unlike a cache it survives the loss of executors.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
