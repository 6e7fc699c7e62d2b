"""Audit of quality filters: what each of five filters removes in every order of application, by part of the corpus.

Words are exploded, aggregated by document and word, then by document for totals and distinct numbers; flags of other
kinds are joined to them. Each document then has one of 32 patterns of failed filters, and 32 conditional counts by part and
label say all there is to know: every figure of every order is a sum of such counts.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import cut, text_or_empty
from evidentia.llm.groups import with_groups

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2
SYMBOLS = "[#$%&*|]"
PATTERNS = 1 << len(FILTERS)
ORDERS = factorial(len(FILTERS))
#: Rows that repeat an id and its text are counted apart by the scan task they come from, modulo this.
SALTS = 64
#: A document by its id and text, so that rows without an id, or with a common one, stay apart.
KEY = ("doc_id", "text_hash", "n_chars")


def zero() -> Column:
    return F.lit(0).cast("long")


def documents_of(docs: DataFrame) -> DataFrame:
    body = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash"), F.length(body).alias("n_chars"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))


def word_counts(documents: DataFrame) -> DataFrame:
    """Total and distinct words of each document that has words.

    Texts are dealt once, before they are exploded, so that neither aggregation shuffles words. A row that is in the
    table r times is counted r times and its words have r first places, by which the totals are divided.
    """
    dealt = documents.select(*KEY, "text", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")).repartition(*KEY, "salt")
    words = dealt.select(*KEY, "salt", F.posexplode(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("place", "word"))
    by_word = words.groupBy(*KEY, "salt", "word").agg(F.count("*").alias("n"), F.count_if(F.col("place") == 0).alias("rows"))
    by_document = by_word.groupBy(*KEY, "salt").agg(F.sum("n").alias("n"), F.count("*").alias("distinct"), F.sum("rows").alias("rows"))
    return by_document.groupBy(*KEY).agg(F.max(F.expr("n div rows")).alias("words"), F.max("distinct").alias("distinct"))


def other_flags(documents: DataFrame) -> DataFrame:
    """Flags C, D and E of each document, and how many equal rows it has."""
    upper = F.octet_length(F.regexp_replace("text", "[^A-Z]+", ""))
    each = documents.select(
        *KEY, "part", F.unhex(F.sha2("text", 256)).alias("digest"), (100 * upper.cast("long") > UPPER_PERCENT * F.col("n_chars").cast("long")).alias("C"), F.col("text").rlike(SYMBOLS).alias("D")
    )
    rows = cut(each.groupBy(*each.columns).agg(F.count("*").alias("rows")))
    texts = cut(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("text_rows")))
    met = with_groups(rows, texts, "digest", "text_rows", [*KEY, "part"])
    return met.withColumn("E", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))).drop("digest", "first_id", "text_rows")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each different (document, part): its part, pattern of failed filters, labels, and number of rows."""
    documents = documents_of(docs)
    flags, counts = other_flags(documents).alias("f"), word_counts(documents).alias("w")
    same = reduce(lambda x, y: x & y, (F.col(f"f.{c}").eqNullSafe(F.col(f"w.{c}")) for c in KEY))
    told = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).withColumn("known", F.lit(True))
    both = flags.join(counts, same, "left").select("f.*", F.coalesce("words", zero()).alias("words"), F.coalesce("distinct", zero()).alias("distinct"))
    # rows without an id are dealt by their text and meet no label
    labelled = both.join(told, (F.coalesce("doc_id", "text_hash") == F.col("label_id")) & (F.col("doc_id").isNotNull() == F.col("known")), "left")
    fails = {"A": F.col("words") < MIN_WORDS, "B": 100 * F.col("distinct") < DISTINCT_PERCENT * F.col("words"), **{c: F.col(c) for c in "CDE"}}
    pattern = reduce(add, (fails[c].cast("int") * (1 << k) for k, c in enumerate(FILTERS)))
    no = F.lit(False)
    return labelled.select("part", pattern.alias("pattern"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "rows")


def pattern_counts(failed: DataFrame) -> DataFrame:
    """By part, the number of documents of each pattern: ``n`` of all, ``n_good`` and ``n_toxic`` of those labelled so."""
    counted = failed.groupBy("part", "good", "toxic").agg(*(F.sum(F.when(F.col("pattern") == k, F.col("rows")).otherwise(zero())).alias(f"c{k}") for k in range(PATTERNS)))
    every = lambda of: F.array(*(F.sum(F.when(of, F.col(f"c{k}")).otherwise(zero())) for k in range(PATTERNS)))
    return counted.groupBy("part").agg(every(F.lit(True)).alias("n"), every(F.col("good")).alias("n_good"), every(F.col("toxic")).alias("n_toxic"))


def steps() -> Column:
    """All steps of all orders: the order, the step's number, its filter's bit and the bits of the filters before it."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for k, c in enumerate(order):
            rows.append({"filter_order": "".join(order), "step": k + 1, "bit": 1 << FILTERS.index(c), "before": before})
            before |= 1 << FILTERS.index(c)
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, bit: int, before: int>>")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step; see the fields below.

    kept: documents left after the step; removed: documents that it takes; redundant: documents that fail its filter and are
    gone already; unique_fails: documents that fail its filter only; good_lost, toxic_lost: removed ones with that label;
    shapley: what its filter removes, summed over all orders.

    A null text is an empty one and a null source the part "". Every row of the table counts, repeated ones too; rows of
    one id and text are no copies of each other to filter E, and a row without an id is no copy and has no label. An id with
    several labels has each that one of its rows gives. Other columns are ignored. An empty table has no parts and no rows.
    """
    counts = pattern_counts(failures(docs, labels))
    row = counts.select("*", F.inline(steps()))
    has = lambda bits: lambda k: k.bitwiseAND(bits) != 0
    own, gone = has(F.col("bit")), has(F.col("before"))
    total = lambda of, weight: F.aggregate(F.transform(of, lambda n, k: n * weight(k)), zero(), add)
    where = lambda of, holds: total(of, lambda k: holds(k).cast("int"))
    removed = lambda of: where(of, lambda k: own(k) & ~gone(k))
    return row.select(
        "part",
        "filter_order",
        "step",
        where("n", lambda k: ~own(k) & ~gone(k)).alias("kept"),
        removed("n").alias("removed"),
        where("n", lambda k: own(k) & gone(k)).alias("redundant"),
        where("n", lambda k: k == F.col("bit")).alias("unique_fails"),
        removed("n_good").alias("good_lost"),
        removed("n_toxic").alias("toxic_lost"),
        # of the filters that a document fails, each comes first in an equal share of the orders
        total("n", lambda k: F.when(own(k), F.lit(ORDERS) / F.bit_count(k)).otherwise(0).cast("long")).alias("shapley"),
    )
