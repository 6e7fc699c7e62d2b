"""Rows joined with the facts of their group, where one group may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group is hot with more than one row in so many; there are fewer hot groups than this, whatever the input.
HOT_SHARE = 1000


def with_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row for each ``key`` and its number of rows as ``size``.

    The facts of hot groups are broadcast, fewer than HOT_SHARE of them by the pigeonhole principle; the others meet by a
    shuffle, in which the rows of hot groups are dealt by the ``spread`` columns instead of their key. ``groups`` is read
    three times: pass a written table. Rows with no group, or a null key, have nulls there.
    """
    total = groups.agg(F.sum(size).alias("n")).first().n or 0
    facts = F.struct(*(c for c in groups.columns if c != key))
    is_hot = F.col(size) * HOT_SHARE > total
    hot = groups.where(is_hot).select(key, facts.alias("_hot"))
    # no plain constant: the optimizer would take it for a condition on the rows and deal them by the key alone
    none = F.when(F.col(size) > 0, F.lit(0).cast("long"))
    cold = groups.where(~is_hot).select(key, none.alias("_deal"), facts.alias("_cold"))
    dealt = F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), 0).otherwise(F.shiftrightunsigned(F.xxhash64(*spread), 1) + 1)
    marked = rows.join(F.broadcast(hot), key, "left").withColumn("_deal", dealt)
    joined = marked.join(cold, [key, "_deal"], "left").withColumn("_facts", F.coalesce("_hot", "_cold"))
    return joined.select(*rows.columns, *(F.col("_facts")[c].alias(c) for c in groups.columns if c != key))
