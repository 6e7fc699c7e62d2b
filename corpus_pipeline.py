"""The corpus pipeline: toxicity filter, near-duplicate removal, secret redaction, source mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import bpe, toxicity
from evidentia.llm.common import cut, ensure_checkpoint_dir, read, text_or_empty
from evidentia.llm.mixing import mix_sources
from evidentia.llm.neardup import near_duplicates
from evidentia.llm.queries import tokenizer_path
from evidentia.llm.secrets import redact, scan_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a score below 0.5, by a model of the labelled rows of ``docs`` that are not held out."""
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), "toxicity")
    return scored.where("toxicity < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group at five-word shingles and a similarity of 0.8: that of the smallest id.

    Rows without words are in no group and stay; of rows that repeat an id and its text one stays. Rows are told by id and
    text: of several texts of an id each is decided alone, and of several rows without an id too, which come last.
    """
    # in the order of the ids: 20 digits of the id above the least long, and a hash of the text
    number = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    rows = docs.withColumn("row_key", F.concat_ws(":", F.coalesce(number, F.lit("none")), F.hex(F.xxhash64("text"))))
    kept = cut(near_duplicates(rows, row_id="row_key").where("kept").groupBy(F.col("doc_id").alias("row_key")).count())
    single = rows.join(kept, "row_key", "left_semi")
    if kept.where("count > 1").limit(1).count():
        single = single.dropDuplicates(["row_key"])
    return single.select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span is replaced by [kind]; n_chars follows."""
    found = scan_secrets(docs.select(*COLUMNS), spans="secret_spans")
    clean = F.when(F.col("text").isNotNull(), redact(F.col("text"), F.col("secret_spans")))
    return found.withColumn("text", clean).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mixture; a row that is read in a second epoch comes twice."""
    return mix_sources(docs, keep=COLUMNS).select("kept.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, which decode to it."""
    path = tokenizer_path()
    return bpe.encode(docs.select("doc_id", "lang", "source", text_or_empty().alias("text")), path).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near-duplicates", drop_near_duplicates), ("secrets", redact_secrets), ("mixing", mix), ("tokens", tokenise)]

#: SQL has no string-kernel machine, MinHash or BPE; tests hold the pipeline against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet in the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
