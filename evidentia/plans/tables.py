"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path beside the session's checkpoints. Without a checkpoint folder a local one serves a local master only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="evidentia-"))
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet beside the session's checkpoints, and read again."""
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
