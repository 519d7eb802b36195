"""Session settings and table loading shared by every job and query."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # plain parquet timestamps load as TIMESTAMP, so range filters push down uncast
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # rows may hold whole texts: what a Python worker holds at once stays small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin UTC, ANSI, adaptive execution and dynamic partition overwrite."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str, cores: int | str = "*") -> SparkSession:
    """Local session for tests and the bench; on a cluster the submit supplies it."""
    builder = (
        SparkSession.builder.appName(app_name).master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LAKEOPS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    return configure(builder.getOrCreate())


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Start shuffles with partitions of about the target size; adaptive execution merges the small ones."""
    n = max(spark.sparkContext.defaultParallelism, -(-int(input_bytes) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode with none set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lakeops-checkpoint-"))
    return context.getCheckpointDir()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table with timestamps as TIMESTAMP under UTC."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Tables:
    """Attribute access to the driver tables: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load_table(self.spark, self.sf_dir, name)
