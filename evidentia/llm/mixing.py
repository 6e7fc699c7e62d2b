"""Hierarchical budgeting: mix sources to target weights, whole-corpus, with DataFrame operations only.

A token budget flows down a domain > language > source tree by integer weights. A child that can not use its share
(its tokens times ``epochs``) is filled, and what it leaves goes to its siblings; only what a whole subtree can not use
goes on to the siblings of its ancestors. Each leaf then takes the longest prefix of its seeded epochs that fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import cut, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_HEX = 3
#: A leaf table is broadcast up to this many rows; beyond that it is joined by a shuffle.
BROADCAST_LEAVES = 10_000

DOMAIN_WEIGHTS = {"web": 50, "books": 30, "code": 20}
LANG_WEIGHTS = {"en": 60, "de": 15, "fr": 15, "es": 10}
SEED, EPOCHS, BUDGET_PERCENT = 17, 2, 80


def domain_of_source(source: Column) -> Column:
    """Sources ending in a number belong to web, books or code by its remainder by 3; others to `web`."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    rest = F.when(number == "", F.lit(0)).otherwise(F.expr("try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT)") % 3)
    return F.when(rest == 1, F.lit("books")).when(rest == 2, F.lit("code")).otherwise(F.lit("web"))


def weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(w)).otherwise(out)
    return out.cast("double")


def fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water-filling of every parent's ``budget`` over its children by ``w``, no child above its ``capacity``.

    In order of capacity per weight, the children that the common level drowns are those before the first one that it
    does not; that level is what they leave, per unit of the weight of the rest.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("w"), name)
    earlier, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*parent)
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0.0))) / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
    leveled = children.withColumn("level", level).withColumn("dry", F.when(F.col("capacity") / F.col("w") > F.col("level"), F.col("level")))
    first_dry = F.first("dry", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return leveled.withColumn("share", F.when(first_dry.isNull(), F.col("capacity")).otherwise(F.col("w") * first_dry)).drop("budget", "level", "dry", "w", "capacity")


def leaf_budgets(leaves: DataFrame, budget_percent: int, epochs: int, domain_weights: dict[str, int], lang_weights: dict[str, int]) -> DataFrame:
    """(domain, lang, source, available) with a whole-token ``leaf_budget``."""
    caps = leaves.withColumn("capacity", F.col("available").cast("double") * epochs)
    root = caps.agg(F.sum("available").alias("n"), F.sum("capacity").alias("most")).select(
        F.lit(1).alias("root"), F.least(F.floor(F.coalesce("n", F.lit(0)) * budget_percent / 100).cast("double"), F.coalesce("most", F.lit(0.0))).alias("budget")
    )
    domains = caps.groupBy("domain").agg(F.sum("capacity").alias("capacity")).withColumn("root", F.lit(1)).withColumn("w", weight("domain", domain_weights))
    by_domain = fill(domains.join(root, "root"), ["root"], "domain").select("domain", F.col("share").alias("budget"))
    langs = caps.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).withColumn("w", weight("lang", lang_weights))
    by_lang = fill(langs.join(by_domain, "domain"), ["domain"], "lang").select("domain", "lang", F.col("share").alias("budget"))
    sources = caps.select("domain", "lang", "source", "capacity", F.lit(1.0).alias("w"))
    by_source = fill(sources.join(by_lang, ["domain", "lang"]), ["domain", "lang"], "source")
    return by_source.join(leaves, ["domain", "lang", "source"]).select("domain", "lang", "source", "available", F.floor("share").cast("long").alias("leaf_budget"))


def mix_sources(
    docs: DataFrame, budget_percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, seed: int = SEED, domain_weights: dict[str, int] = DOMAIN_WEIGHTS, lang_weights: dict[str, int] = LANG_WEIGHTS, keep: list[str] | None = None
) -> DataFrame:
    """The chosen rows, one for each epoch in which a row is taken.

    ``docs`` has doc_id, text, lang, source. The budget is ``budget_percent`` of the corpus tokens (words); a leaf can be
    read ``epochs`` times, each time in another order: that of md5(seed:epoch:doc_id). A leaf's rows are taken in this
    order while their tokens so far fit its budget. Null lang and source become `unknown`; a null or empty text has no
    tokens; among rows of equal doc_id the longer come first and equal ones are interchangeable; an empty table gives
    none. ``keep`` names input columns to return beside doc_id, epoch, domain, lang, source, n_tokens, leaf_budget;
    they come back unchanged, under ``kept``.

    Prefix sums run over at most 4096 hash buckets a leaf and epoch; rows are sorted only in a leaf's one bucket where
    its budget ends.
    """
    leaf = ["domain", "lang", "source"]
    source = F.coalesce(F.col("source"), F.lit("unknown"))
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("unknown")).alias("lang"), source.alias("source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("n_tokens"), *([F.struct(*keep).alias("kept")] if keep else []),
    ).withColumn("domain", domain_of_source(F.col("source")))
    light = cut(rows.select(*leaf, "doc_id", "n_tokens"))  # texts are counted once
    rows = rows if keep else light

    def ordered(df: DataFrame, e: Column) -> DataFrame:
        key = F.md5(F.concat_ws(":", F.lit(str(seed)), e.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key")
        return df.select("*", e.alias("epoch"), key).withColumn("bucket", F.substring("key", 1, BUCKET_HEX))

    # each row's epochs are met in the map side; what is shuffled are sums by leaf, epoch and bucket
    every = light.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("e"))
    sums = ordered(every, F.col("e")).groupBy(*leaf, "epoch", "bucket").agg(F.sum("n_tokens").alias("n_tokens"))
    leaves = sums.where("epoch = 0").groupBy(*leaf).agg(F.sum("n_tokens").alias("available"))
    budgets = leaf_budgets(leaves, budget_percent, epochs, domain_weights, lang_weights)
    so_far = Window.partitionBy(*leaf).orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = sums.withColumn("upto", F.sum("n_tokens").over(so_far)).join(budgets.drop("available"), leaf)
    # the first bucket that does not fit whole; before it all rows are taken, after it none
    ends = filled.groupBy(*leaf, "leaf_budget").agg(
        F.min(F.when(F.col("upto") > F.col("leaf_budget"), F.struct("epoch", "bucket", (F.col("upto") - F.col("n_tokens")).alias("before")))).alias("end")
    )
    ends = cut(ends)
    small = ends.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    placed = rows.join(F.broadcast(ends) if small else ends, leaf)
    final = F.coalesce(F.col("end.epoch"), F.lit(epochs))
    placed = ordered(placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("e")), F.col("e")).drop("e")
    whole = (F.col("epoch") < final) | ((F.col("epoch") == final) & (F.col("bucket") < F.col("end.bucket")))
    split = (F.col("epoch") == final) & (F.col("bucket") == F.col("end.bucket"))
    out = ["doc_id", "epoch", *leaf, "n_tokens", "leaf_budget", *(["kept"] if keep else [])]
    in_order = Window.partitionBy(*leaf).orderBy("key", "doc_id", F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.where(split).withColumn("upto", F.col("end.before") + F.sum("n_tokens").over(in_order)).where("upto <= leaf_budget")
    return placed.where(whole).select(*out).unionByName(last.select(*out))
