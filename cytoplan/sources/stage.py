"""Stages of iterative plans: written to the session's shared checkpoint folder and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_path(spark: SparkSession) -> str:
    """A new path on shared storage; a folder is made only where none is set and all tasks run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cytoplan-stage-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Cuts lineage on shared storage."""
    path = stage_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
