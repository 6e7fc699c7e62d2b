"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make a local one only where none is set (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="evidentia-checkpoint-"))


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and read again.

    Later jobs reread it, so lost executors cost nothing; unlike checkpoint() it also leaves the constraints of the
    plan behind, which iterations would let grow without end, and it is compressed.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete the files of tables that ``cut`` wrote and that nothing reads any more; other frames stay as they are."""
    for table in tables:
        path = _paths.pop(table, None) if table is not None else None
        if path is not None:
            context = table.sparkSession.sparkContext
            file = context._jvm.org.apache.hadoop.fs.Path(path)
            file.getFileSystem(context._jsc.hadoopConfiguration()).delete(file, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
