"""Checks of produced tables: counts that must be reached, or must be zero."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checked(name: str, rows: DataFrame, tests: Mapping[str, tuple[Column, str, int]]) -> DataFrame:
    """(table, check, n, passed) of all tests of a table, in one aggregation; an empty table passes them all.

    A test is a predicate, `ge` or `eq`, and the count that its rows are compared with.
    """
    counts = rows.agg(F.count("*").alias("_all"), *(F.count_if(test).alias(k) for k, (test, _, _) in tests.items()))
    line = lambda k, how, n: F.struct(F.lit(name).alias("table"), F.lit(k).alias("check"), F.col(k).alias("n"), ((F.col("_all") == 0) | (F.col(k) >= n if how == "ge" else F.col(k) == n)).alias("passed"))
    return counts.select(F.explode(F.array(*(line(k, how, n) for k, (_, how, n) in tests.items()))).alias("c")).select("c.*")
