"""Projection to typed documents: coercions, fallbacks with verbatim overflow, and related values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.ids import is_ip
from evidentia.functions.times import iso_z, parse_ts

#: Confidence words as numbers.
CONFIDENCE = {"definitive": 1.0, "heuristic": 0.5, "inferred": 0.2}


def to_date(text: Column) -> Column:
    return iso_z(parse_ts(text))


def to_long(text: Column) -> Column:
    """An integer, or a float without a fraction."""
    t = F.trim(text)
    return F.coalesce(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), F.when(t.rlike(r"^[+-]?\d+\.0+$"), F.split_part(t, F.lit("."), F.lit(1)).try_cast("bigint")))


def to_float(text: Column) -> Column:
    return F.when(F.trim(text).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.trim(text).try_cast("double"))


def to_boolean(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.isin("1", "true", "yes", "on"), True).when(t.isin("0", "false", "no", "off"), False)


def to_ip(text: Column) -> Column:
    return F.when(is_ip(F.trim(text)), F.trim(text))


COERCIONS = {"date": to_date, "long": to_long, "float": to_float, "boolean": to_boolean, "ip": to_ip}


def coerced(kind: str, *sources: Column) -> tuple[Column, Column]:
    """The first source that the type takes, and the first of the others' texts that it does not."""
    make = COERCIONS[kind]
    return F.coalesce(*(make(s) for s in sources)), F.coalesce(*(F.when(make(s).isNull(), s) for s in sources))


def confidence(word: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in CONFIDENCE.items() for x in pair)), word)


def related(*values: Column) -> Column:
    """Distinct values that are there, in order."""
    return F.array_distinct(F.array_compact(F.array(*(F.when(v != "", v) for v in values))))


def hive_short(key: Column) -> Column:
    """Registry root names in their short form."""
    #: Fixed values.
    roots = {"HKEY_LOCAL_MACHINE": "HKLM", "HKEY_CURRENT_USER": "HKCU", "HKEY_USERS": "HKU", "HKEY_CLASSES_ROOT": "HKCR", "HKEY_CURRENT_CONFIG": "HKCC"}
    head = F.split_part(key, F.lit("\\"), F.lit(1))
    short = F.try_element_at(F.create_map(*(F.lit(x) for pair in roots.items() for x in pair)), F.upper(head))
    return F.when(short.isNotNull(), F.concat(short, F.substring(key, F.length(head) + 1, F.length(key)))).otherwise(key)


def outcome(kind: Column, action: Column) -> Column:
    return F.when((kind == "authentication") & (action == "success"), "success").when((kind == "authentication") & action.isin("failure", "error"), "failure").otherwise("unknown")
