"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skewed joins are split at run time and build sides are broadcast only once their
# measured size is under the threshold; nothing in this package forces a broadcast.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Stages whose generated method the JIT would refuse run expression by expression instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors can reach. Only for a local
    master, where all run on one machine, is it set here if it is not set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "checkpoints", f"ledgerloom-{uuid.uuid4().hex[:12]}")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back: computed once, lineage cut, and it
    outlives any executor."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
