"""Folding observations of one event into one row, with the contributors' evidence."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.blanks import is_missing

KEYS = ["source_host", "car_object", "guid", "car_action", "target_guid", "access_level"]
#: Contributors and conflicts that are listed for a row.
LISTED = 64


def first_present(column: str, seq: str = "seq") -> Column:
    """The first value in order that is not missing."""
    return F.min_by(column, F.when(~is_missing(F.col(column).cast("string")), F.col(seq)))


def additive(events: DataFrame, keys: list[str] = KEYS, guid: str = "guid", seq: str = "seq", artefact: str = "source_artefact") -> DataFrame:
    """One row a key: of each column the first value that is there, in the order of ``seq``.

    Null keys group together; rows without a guid are never folded. ``contributions`` counts the rows,
    ``contributed_by`` lists their artefacts, and ``conflicts`` the columns in which contributors disagree.
    """
    values = [c for c in events.columns if c not in (*keys, seq)]
    known, loose = events.where(F.col(guid).isNotNull()), events.where(F.col(guid).isNull())
    present = {c: F.when(~is_missing(F.col(c).cast("string")), F.col(c).cast("string")) for c in values if c != artefact}
    # two values or more: the least is not the greatest; one pass, no row is repeated for a column
    distinct = {c: F.min(v) != F.max(v) for c, v in present.items()}
    disagree = F.array_compact(F.array(*(F.when(F.col(f"_n_{c}"), F.lit(c)) for c in distinct))) if distinct else F.array().cast("array<string>")
    folded = known.groupBy(*keys).agg(
        F.min(seq).alias(seq), *(first_present(c, seq).alias(c) for c in values), F.count("*").alias("contributions"),
        F.slice(F.array_sort(F.collect_set(artefact)), 1, LISTED).alias("contributed_by"), *(n.alias(f"_n_{c}") for c, n in distinct.items()),
    )
    folded = folded.withColumn("conflicts", disagree).drop(*(f"_n_{c}" for c in distinct))
    alone = loose.withColumns({"contributions": F.lit(1).cast("long"), "contributed_by": F.array_compact(F.array(artefact)), "conflicts": F.array().cast("array<string>")})
    return folded.unionByName(alone.select(*folded.columns))


def most_populated(events: DataFrame, keys: list[str] = KEYS, guid: str = "guid", seq: str = "seq") -> DataFrame:
    """One row a key: the one with most values, the first of several."""
    values = [c for c in events.columns if c not in keys]
    filled = sum((F.when(is_missing(F.col(c).cast("string")), 0).otherwise(1) for c in values if c != seq), F.lit(0))
    best = F.max_by(F.struct(*values), F.struct(filled, -F.col(seq))).alias("best")
    known, loose = events.where(F.col(guid).isNotNull()), events.where(F.col(guid).isNull())
    return known.groupBy(*keys).agg(best).select(*keys, "best.*").unionByName(loose.select(*keys, *values))


#: What the fold itself writes into a native bag, and a row's place in the evidence: neither merged nor in conflict.
OWN_ENTRIES = ["coalesced_sources", "coalesced_conflicts", "contributions", "contributed_by", "spindle_ref"]


def merged(events: DataFrame, keys: list[str], order: list[str], guid: str = "guid", artefact: str = "source_artefact") -> DataFrame:
    """One row for each event: the first observation, filled with what later ones add in columns and in the bags props and native.

    What others say otherwise is kept in the native bag: ``coalesced_conflicts`` has for each field the other values, with the
    first artefact of each, ``coalesced_sources`` the artefacts, ``contributions`` the number of rows and ``contributed_by`` the
    first of them. Lists have LISTED entries at most, in order. Rows without a guid are never folded, and a lone row stays as it is.

    Only events of several rows are taken apart, entry by entry, so no bag is collected whole.
    """
    same = lambda a, b: reduce(and_, (a[k].eqNullSafe(b[k]) for k in keys))
    at = F.struct(*order)
    bags, columns = ["props", "native"], [c for c in events.columns if c not in (*keys, *order, "props", "native", artefact)]
    rest = [c for c in events.columns if c not in keys]
    known, loose = events.where(F.col(guid).isNotNull()), events.where(F.col(guid).isNull())
    base = known.groupBy(*keys).agg(F.min_by(F.struct(*rest), at).alias("_b"), F.count("*").alias("_n"))
    several = base.where("_n > 1").select(*keys)
    rows = known.join(several, same(known, several), "left_semi")
    pairs_of = lambda b: F.transform(F.map_entries(b), lambda e: F.struct(F.lit(b).alias("bag"), e["key"].alias("name"), e["value"].alias("value")))
    pairs = [pairs_of(b) for b in bags]
    pairs.append(F.array(*(F.struct(F.lit("").alias("bag"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns)))
    entries = rows.select(*keys, at.alias("_at"), artefact, F.explode(F.concat(*pairs)).alias("e")).select(*keys, "_at", artefact, "e.*")
    entries = entries.where(~is_missing(F.col("value")) & ~((F.col("bag") == "native") & F.col("name").isin(OWN_ENTRIES)))
    values = entries.groupBy(*keys, "bag", "name", "value").agg(F.min("_at").alias("_at"), F.min_by(artefact, "_at").alias(artefact))
    # the limit on the rank is applied before the shuffle, too
    ranked = values.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "bag", "name").orderBy("_at", "value"))).where(F.col("_r") <= LISTED + 1)
    told = ranked.groupBy(*keys, "bag", "name").agg(F.min_by("value", "_r").alias("value"), F.array_sort(F.collect_list(F.when(F.col("_r") > 1, F.struct("_r", artefact, "value")))).alias("others"))
    bag = lambda b: F.map_from_entries(F.collect_list(F.when(F.col("bag") == b, F.struct("name", "value"))))
    field = F.when(F.col("bag") == "native", F.concat(F.lit("native."), "name")).otherwise(F.col("name"))
    others = F.transform("others", lambda o: F.struct(o[artefact].alias("source_artefact"), o["value"].alias("value")))
    fields = told.groupBy(*keys).agg(bag("props").alias("_props"), bag("native").alias("_native"), bag("").alias("_columns"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.size("others") > 0, F.struct(field, others))))).alias("_conflicts"))
    first = lambda what, name: what.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))).where(F.col("_r") <= LISTED).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_r", "_what"))).alias(name))
    place = F.try_element_at("native", F.lit("spindle_ref"))
    by = first(rows.select(*keys, at.alias("_at"), F.struct(F.col(artefact).alias("source_artefact"), place.alias("spindle_ref")).alias("_what")), "_by")
    sources = first(rows.groupBy(*keys, F.col(artefact).alias("_what")).agg(F.min(at).alias("_at")), "_sources")
    facts = fields
    for more in (by, sources):
        facts = facts.join(more, same(facts, more)).select(*(facts[c] for c in facts.columns), more[more.columns[-1]])
    out = base.join(facts, same(base, facts), "left").select(*(base[k] for k in keys), "_b", "_n", *(facts[c] for c in facts.columns if c not in keys))
    listed = lambda c: F.to_json(F.transform(c, lambda x: x["_what"]))
    own = F.create_map(F.lit("contributions"), F.col("_n").cast("string"), F.lit("contributed_by"), listed("_by"), F.lit("coalesced_sources"), listed("_sources"))
    own = F.when(F.size("_conflicts") > 0, F.map_concat(own, F.create_map(F.lit("coalesced_conflicts"), F.to_json("_conflicts")))).otherwise(own)
    kept = F.map_filter("_b.native", lambda k, v: k.isin(OWN_ENTRIES) & ~F.map_contains_key(own, k))
    folded = {"props": F.col("_props"), "native": F.map_concat("_native", kept, own)} | {c: F.try_element_at("_columns", F.lit(c)).cast(events.schema[c].dataType) for c in columns}
    picked = {c: F.when(F.col("_n") > 1, folded[c]).otherwise(F.col(f"_b.{c}")) if c in folded else F.col(f"_b.{c}") for c in rest}
    return out.select(*keys, *(v.alias(c) for c, v in picked.items())).unionByName(loose)


def documents(entries: DataFrame, key: str, field: str, value: str, order: str) -> DataFrame:
    """(key, fields, conflicts): documents put together from entries, rows of (key, field, value, listed), in the order of ``order``.

    Of a field the first value fills it; other values of a listed field are added to it, in their order, and other values of a
    plain one are its conflicts. Fields and conflicts are maps from names to lists of at most LISTED values; a plain field's list
    has one. Nulls and blanks fill nothing. Values are ranked by name before anything is gathered.
    """
    there = entries.where(F.coalesce(F.col(value), F.lit("")) != "")
    distinct = there.groupBy(key, field, value).agg(F.min(order).alias("_at"), F.max("listed").alias("listed"))
    ranked = distinct.withColumn("_r", F.row_number().over(Window.partitionBy(key, field).orderBy("_at", value))).where(F.col("_r") <= LISTED + 1)
    lists = ranked.groupBy(key, field).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", value))), lambda x: x[value]).alias("_all"), F.max("listed").alias("listed"))
    whole = F.when(F.col("listed"), F.slice("_all", 1, LISTED)).otherwise(F.slice("_all", 1, 1))
    others = F.when(~F.col("listed") & (F.size("_all") > 1), F.struct(F.col(field), F.slice("_all", 2, LISTED)))
    maps = lists.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(field), whole)))).alias("fields"), F.map_from_entries(F.array_sort(F.collect_list(others))).alias("conflicts"))
    return maps
