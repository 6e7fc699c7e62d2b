"""Exact deduplication as a stream: keyed state on disk, without expiry, by digest of the normalised text.

The state of a digest is what a later copy has to meet: the number of rows, the identifier of the row that stays and
where its contents lie (file and row). It is kept by RocksDB in the streaming checkpoint. Rows are combined before they
are dealt, so a group of copies sends one row of a task to its state. Digests only propose: every hit, that is every row of
a digest met before, is compared by its whole bytes, and texts that only share a digest are told apart.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidentia.llm.common import cut, drop, ensure_checkpoint_dir, text_or_empty
from evidentia.llm.groups import with_groups

SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of input of one micro-batch. Larger batches write the state of a digest less often.
PER_TRIGGER = 64 << 30
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # only what a batch changed is written to the checkpoint, and all stores of an executor share one bounded memory
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # many small stores would each reserve some megabytes of disk ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
CHANGED = "digest binary, group_size long, best struct<chars: long, back: long, doc_id: long, file: string, row: long>"
Digest = Callable[[Column], Column]


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def located(rows: DataFrame, text: str, row_id: str, digest: Digest) -> DataFrame:
    """Normalised text, its digest, the original length, id, and the place of each row of a file scan."""
    body = F.regexp_replace(text_or_empty(text), SPACE, "")
    return rows.select(
        body.alias("body"),
        digest(body).alias("digest"),
        F.length(text_or_empty(text)).cast("long").alias("chars"),
        F.col(row_id).cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def best() -> Column:
    """Of several rows the one with most code points, then smallest id; of rows without an id, or with the same, the last in place."""
    return F.max(F.struct("chars", F.bitwise_not("doc_id").alias("back"), "doc_id", "file", "row")).alias("best")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time in which a query is started, which copies them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def digest_groups(stream: DataFrame) -> DataFrame:
    """The keyed state over a stream of located rows: for each digest its rows so far and the row that stays of these."""
    return stream.groupBy("digest").agg(F.count("*").alias("group_size"), best())


def follow(spark: SparkSession, path: str, schema: StructType, folder: str, text: str, row_id: str, digest: Digest, per_trigger: int) -> DataFrame:
    """Send what ``path`` has and ``folder`` has not seen through the state; returns the groups of all that was seen.

    Each micro-batch writes the digests that it changed under its number, so one that is repeated after a failure replaces
    its own rows. A further run with the same folder goes on from the state there.
    """
    changed = f"{folder}/changed"
    spark.createDataFrame([], CHANGED).write.mode("overwrite").parquet(f"{changed}/batch=-1")
    # a pattern that only this path fits: the source takes a pattern for a single file too, but no plain path to one
    pattern = re.sub(r"(.)/*$", r"[\1]", path)
    source = spark.readStream.schema(schema).option("maxBytesPerTrigger", per_trigger).parquet(pattern)
    with settings(spark, STATE):
        stream = (
            digest_groups(located(source, text, row_id, digest)).writeStream.outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", f"{folder}/state")
            .foreachBatch(lambda rows, k: rows.write.mode("overwrite").parquet(f"{changed}/batch={k}"))
            .start()
        )
    stream.awaitTermination()
    said = spark.read.schema(CHANGED).parquet(changed)
    # the last change of a digest has its largest number of rows
    return said.groupBy("digest").agg(F.max(F.struct("group_size", "best")).alias("last")).select("digest", "last.*")


def collisions(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests with rows of different bytes: all hits are compared whole, by the extremes of each digest, not in pairs."""
    sizes = groups.select("digest", "group_size")
    hits = with_groups(rows.select("digest", "body", "file", "row"), sizes, "digest", "group_size", ["file", "row"]).where("group_size > 1")
    return hits.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high")).where("low <> high").select("digest")


def members(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    met = with_groups(rows.withColumn("text_sha256", F.sha2("body", 256)).select(*{key: 0, "doc_id": 0, "file": 0, "row": 0, "text_sha256": 0}), groups, key, "group_size", ["file", "row"])
    kept = (F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))
    return met.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")


def deduplicate(spark: SparkSession, path: str, text: str = "text", row_id: str = "doc_id", digest: Digest = sha256, per_trigger: int = PER_TRIGGER, folder: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of the Parquet files at ``path``.

    Texts are equal if they are identical without white space (space and tab to carriage return). Of equal texts the row with
    the most code points stays, then the one of the smallest id; of rows that repeat an id and a length too, the last by file
    and place, so one row stays in each group whatever repeats. A row without an id gives way to one with an id and length.
    A null text is an empty one; empty texts are one group. Other columns are ignored. An empty table gives no rows.

    ``folder`` keeps the state for later runs, which then read only files they have not seen; without it a new one in
    ``spark.checkpoint.dir`` is used. ``digest`` is what the state is keyed by; equal bytes have equal digests, and texts that only
    share a digest are grouped again by their bytes.
    """
    ensure_checkpoint_dir(spark)
    folder = folder or f"{spark.sparkContext.getCheckpointDir()}/exact-{uuid.uuid4().hex}"
    docs = spark.read.parquet(path)
    groups = cut(follow(spark, path, docs.schema, folder, text, row_id, digest, per_trigger))
    rows = located(docs, text, row_id, digest)
    apart = cut(collisions(rows, groups))
    if apart.isEmpty():
        drop(apart)
        return members(rows, groups, "digest")
    alone = rows.join(apart, "digest", "left_semi")
    by_body = cut(alone.groupBy("body").agg(F.count("*").alias("group_size"), best()))
    return members(rows.join(apart, "digest", "left_anti"), groups, "digest").unionByName(members(alone, by_body, "body"))
