"""Scans of JSON lines as tools write them, containers with physical line numbers, and per-object sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.plans.model import FIELDS, conform, schema
from evidentia.plans.tables import written


def scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, record): every line that is a JSON object; array brackets, trailing commas and broken lines are skipped.

    ``record`` is a VARIANT. Rejected lines can be counted with ``rejected``.
    """
    lines = trimmed(spark.read.text(path))
    good = lines.where(F.col("line").startswith("{") & F.col("line").endswith("}"))
    return good.select("path", F.try_parse_json("line").alias("record")).where("record IS NOT NULL")


def rejected(spark: SparkSession, path: str | list[str]) -> int:
    lines = trimmed(spark.read.text(path))
    return lines.where(~F.col("line").startswith("{") | ~F.col("line").endswith("}") | F.try_parse_json("line").isNull()).count()


def trimmed(lines: DataFrame) -> DataFrame:
    text = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), r"^[\s \u0085  ]+|[\s, \u0085  ]+$", "")
    return lines.select(F.col("_metadata.file_path").alias("path"), text.alias("line")).where(~F.col("line").isin("", "[", "]"))


def field(name: str, kind: str = "string", record: str = "record") -> Column:
    """A value of a record by its (possibly dotted) key; null where it is absent or of another type."""
    return F.try_variant_get(record, f'$["{name}"]', kind)


def numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, record_id, line) of the lines of containers that are not blank; the number is that of the physical line.

    Lines end with \\n, \\r\\n or \\r, and blank ones count. A file is read in splits: a line's number is its place in its split
    plus the lines of the splits before it. Bytes that are no UTF-8 become replacement characters.
    """
    at = {"path": F.col("_metadata.file_path"), "split": F.col("_metadata.file_block_start"), "place": F.monotonically_increasing_id()}
    # a table, so that the places are those that were counted, however later jobs would cut the files
    lines = written(spark.read.text(path).select(*(v.alias(k) for k, v in at.items()), F.make_valid_utf8("value").alias("line")))
    splits = lines.groupBy("path", "split").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("path", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    kept = lines.withColumn("line", F.regexp_replace("line", r"^[\s\u0085\u00a0\u2028\u2029\u001c-\u001f]+|[\s\u0085\u00a0\u2028\u2029\u001c-\u001f]+$", "")).where("line <> ''")
    return kept.join(starts, ["path", "split"]).select("path", (F.col("place") + F.col("shift")).alias("record_id"), "line")


def parser_table(parser: Column) -> Column:
    """Table of a container's parser name: what is before a slash, in camel case, after L2t."""
    head = F.split_part(F.coalesce(parser, F.lit("")), F.lit("/"), F.lit(1))
    words = F.filter(F.split(head, "[^A-Za-z0-9]+"), lambda w: w != "")
    camel = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")
    return F.concat(F.lit("L2t"), F.when(camel == "", "Unknown").otherwise(camel))


def wrap_container(lines: DataFrame, image: str) -> DataFrame:
    """Container lines as rows (source_image, record_id, parser, table, timestamp, record) for the maps of their tables."""
    parsed = lines.withColumn("record", F.try_parse_json("line")).where("record IS NOT NULL")
    micros = F.try_variant_get("record", "$.timestamp", "bigint")
    stamp = F.when(micros > 0, F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    parser = F.try_variant_get("record", "$.parser", "string")
    return parsed.select(F.lit(image).alias("source_image"), "record_id", parser.alias("parser"), parser_table(parser).alias("table"), stamp.alias("timestamp"), "record")


def container_tables(spark: SparkSession, path: str, image: str, folder: str) -> list[str]:
    """Write a container's rows below ``folder``, a table for each parser, as the maps of the tables read them; their names.

    A row is (record): SourceImage, RecordId, Parser, Timestamp and, as Record, what the container's line has. Lines that are no
    objects, or wrapped already, are left out.
    """
    rows = wrap_container(numbered(spark, path), image)
    bare = F.schema_of_variant("record").startswith("OBJECT") & F.try_variant_get("record", "$.data_type", "variant").isNotNull() & F.try_variant_get("record", "$.Record", "variant").isNull()
    row = F.struct(F.col("source_image").alias("SourceImage"), F.col("record_id").alias("RecordId"), F.coalesce("parser", F.lit("unknown")).alias("Parser"), F.col("timestamp").alias("Timestamp"), F.col("record").alias("Record"))
    rows.where(bare).select("table", F.to_variant_object(row).alias("record")).write.mode("overwrite").partitionBy("table").parquet(folder)
    return [r.table for r in spark.read.parquet(folder).select("table").distinct().collect()]


def read_container_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(folder).where(F.col("table") == table).drop("table")


def write_tree(events: DataFrame, path: str) -> None:
    """A folder of JSON lines for each object, with all columns of the object, nulls too."""
    for kind in FIELDS:
        conform(events, kind).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/car_{kind}")


def read_tree(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """An object's rows; lines that are no rows are skipped."""
    return spark.read.schema(schema(kind)).option("mode", "DROPMALFORMED").json(f"{path}/car_{kind}")


def bulk_lines(documents: DataFrame, doc_id: str, doc: str) -> DataFrame:
    """(value): an action line and a document line for each document, for bulk loading."""
    action = F.to_json(F.struct(F.struct(F.col(doc_id).alias("_id")).alias("create")))
    return documents.select(F.explode(F.array(action, F.to_json(doc))).alias("value"))
