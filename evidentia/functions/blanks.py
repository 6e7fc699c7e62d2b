"""The notions of an absent value, each with its own name; stages differ in which one they use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def nb(value: Column) -> Column:
    """The value, or null where it is blank: null, empty or a lone dash (maps)."""
    return F.when(~value.isin("", "-"), value)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often the body has it.

    In a branch of a conditional Spark makes a value again wherever it is written; nested functions that have theirs
    several times would multiply.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_missing(value: Column) -> Column:
    """Null or empty (fold and derivation)."""
    return value.isNull() | (value == "")


def present(value: Column) -> Column:
    """The value, or null where it is missing."""
    return F.when(value != "", value)


def is_empty(value: Column) -> Column:
    """Null or only white space (verification)."""
    return value.isNull() | (F.trim(value) == "")


def unidentified(value: Column) -> Column:
    """Null, white space or a lone dash (asset registry)."""
    return value.isNull() | F.trim(value).isin("", "-")


def truthy(value: Column, kind: str = "string") -> Column:
    """Whether a scripting language takes the value for true: not null, empty, zero or false; a dash is true."""
    if kind == "boolean":
        return F.coalesce(value, F.lit(False))
    if kind == "array":
        return F.coalesce(F.size(value) > 0, F.lit(False))
    if kind == "number":
        return F.coalesce(value != 0, F.lit(False))
    return F.coalesce(value != "", F.lit(False))


def two_valued(test: Column) -> Column:
    """A predicate that is false where it would be unknown."""
    return F.coalesce(test, F.lit(False))
