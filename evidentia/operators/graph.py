"""Edges, reconstructed nodes, content nodes, convergence across sources, and components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.plans.model import VERBS

#: Values that are listed of one property of a node.
LISTED = 64


def verb_of(kind: Column, action: Column) -> Column:
    """Verb of an owner's edge."""
    table = F.create_map(*(F.lit(x) for k, actions in VERBS.items() for a, v in actions.items() for x in (f"{k}/{a}", v)))
    return F.coalesce(F.try_element_at(table, F.concat_ws("/", kind, action)), F.lit("accessed"))


def edges(rows: DataFrame, kinds: list[Column]) -> DataFrame:
    """All edge kinds of every row in one scan; a kind is a struct, null where the row has no such edge."""
    # an array of its own, whole: neither a generator that makes it nor a function over its entries has generated code
    return rows.select(F.array(*kinds).alias("all")).select(F.explode("all").alias("e")).where("e IS NOT NULL").select("e.*")


def edge(relationship: Column, start: tuple[str, Column], end: tuple[str, Column], when: Column, timestamp: Column, **more: Column) -> Column:
    """An edge struct, where ``when`` holds and both ends (object and guid) are known."""
    known = when & start[1].isNotNull() & end[1].isNotNull()
    fields = [timestamp.alias("timestamp"), relationship.alias("relationship"), F.lit(start[0]).alias("source_object"), start[1].cast("string").alias("source_guid"), F.lit(end[0]).alias("target_object"), end[1].cast("string").alias("target_guid")]
    return F.when(known, F.struct(*fields, *(v.alias(k) for k, v in more.items())))


def lookup_fanout(edges_: DataFrame) -> DataFrame:
    """Up to two rows an edge, one for each end that is known: entity, direction, other end, verb."""
    end = lambda own, other, way: F.when(F.coalesce(F.col(f"{own}_guid"), F.lit("")) != "", F.struct(F.col(f"{own}_guid").alias("entity"), F.lit(way).alias("direction"), F.col(f"{other}_guid").alias("other"), "relationship"))
    return edges_.select(F.explode(F.array_compact(F.array(end("source", "target", "out"), end("target", "source", "in")))).alias("e")).select("e.*")


def missing_references(references: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """References whose target was never observed (an anti-join on all keys)."""
    return references.join(observed.select(*keys).distinct(), keys, "left_anti")


def reconstruct(references: DataFrame, observed: DataFrame, keys: list[str], rule: str, at: str) -> DataFrame:
    """One node for each missing target: its rules, how often and when it was referred to."""
    return missing_references(references, observed, keys).groupBy(*keys).agg(F.array_sort(F.collect_set(rule)).alias("rules"), F.count("*").alias("references"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))


def first_values(said: DataFrame, keys: list[str], prop: str, value: str, order: str, limit: int | None = LISTED) -> DataFrame:
    """(keys, values): of each property its different values by ``order``, the first ``limit`` or all of them, as arrays by name.

    The values are made different, and with a limit ranked, by aggregations and a limited rank that both work before the shuffle;
    only what is listed is collected.
    """
    listed = said.where(F.col(value).isNotNull()).groupBy(*keys, prop, value).agg(F.min(order).alias("_at"))
    if limit is not None:
        listed = listed.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, prop).orderBy("_at", value))).where(F.col("_r") <= limit)
    lists = listed.groupBy(*keys, prop).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at" if limit is None else "_r", value))), lambda x: x[value]).alias("_values"))
    return lists.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(prop, "_values")))).alias("values"))


def content_nodes(rows: DataFrame, identity: str, at: str, properties: list[str]) -> DataFrame:
    """A node for each identity value: references, first and last time, and the smallest values of its properties, LISTED at most."""
    named = rows.where(F.coalesce(F.col(identity), F.lit("")) != "")
    nodes = named.groupBy(identity).agg(F.count("*").alias("ref_count"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))
    flat = F.array(*(F.struct(F.lit(p).alias("property"), F.col(p).alias("value")) for p in properties))
    said = named.select(identity, F.explode(flat).alias("p")).select(identity, "p.*").withColumn("_at", F.lit(0))
    lists = first_values(said, [identity], "property", "value", "_at")
    empty = F.array().cast("array<string>")
    return nodes.join(lists, identity, "left").select(identity, "ref_count", "first_seen", "last_seen", *(F.coalesce(F.try_element_at("values", F.lit(p)), empty).alias(p) for p in properties))


def member_sets(rows: DataFrame, tiers: list[tuple[str, Column]], row: str, source: str) -> DataFrame:
    """(tier, join_key, row, source): the rows that share a key over two sources or more, one row for each member.

    Keys with the same members count once, at the best tier. Members are never gathered: a set is known by its number of
    members and two sums of their hashes, whatever their order.
    """
    keys = F.array_compact(F.array(*(F.when(k.isNotNull() & (k != ""), F.struct(F.lit(n).alias("rank"), F.lit(t).alias("tier"), k.alias("join_key"))) for n, (t, k) in enumerate(tiers))))
    long = rows.select(row, source, F.explode(keys).alias("k")).select(row, source, "k.*")
    by = ["rank", "tier", "join_key"]
    members = long.groupBy(*by, row).agg(F.min(source).alias("_low"), F.max(source).alias("_high"))
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), F.col(row)).cast("decimal(38,0)"))
    sets = members.groupBy(*by).agg(F.count("*").alias("n"), digest(1).alias("s1"), digest(2).alias("s2"), F.min("_low").alias("low"), F.max("_high").alias("high")).where("low <> high")
    best = sets.groupBy("n", "s1", "s2").agg(F.min(F.struct(*by)).alias("b")).select("b.*")
    return long.join(best, by).select("tier", "join_key", row, source).distinct()


def converge(rows: DataFrame, tiers: list[tuple[str, Column]], row: str, source: str) -> DataFrame:
    """(tier, join_key, sources, members) of ``member_sets``, each set in one row: for reports on keys of few members."""
    return member_sets(rows, tiers, row, source).groupBy("tier", "join_key").agg(F.array_sort(F.collect_set(source)).alias("sources"), F.array_sort(F.collect_set(row)).alias("members"))


def merged_properties(rows: DataFrame, group: str, properties: list[str], order: str) -> DataFrame:
    """(group, property, value, conflicts): the first value of each property and how many others disagree with it."""
    flat = F.array(*(F.struct(F.lit(p).alias("property"), F.col(p).cast("string").alias("value")) for p in properties))
    long = rows.select(group, order, F.explode(flat).alias("p")).select(group, order, "p.*").where(F.coalesce(F.col("value"), F.lit("")) != "")
    return long.groupBy(group, "property").agg(F.min_by("value", order).alias("value"), (F.count_distinct("value") - 1).alias("conflicts"))


def components(nodes: DataFrame, links: DataFrame, cut) -> DataFrame:
    """(id, component): the smallest id within reach, by passing on labels and following them; ``cut`` materialises."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(nodes.select("id", F.col("id").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id", "left").select("id", "component", F.least("component", F.coalesce("near", "component")).alias("next"))
        lower = cut(lower)
        ahead = lower.select(F.col("id").alias("next"), F.col("next").alias("after"))
        labels = cut(lower.join(ahead, "next", "left").select("id", F.coalesce("after", "next").alias("component"), (F.coalesce("after", "next") != F.col("component")).alias("moved")))
        if not labels.where("moved").limit(1).count():
            return labels.select("id", "component")


def timeline(objects: list[tuple[str, DataFrame]], host: str | None = None, after: str | None = None, before: str | None = None) -> DataFrame:
    """One ordered table of entries (ts, kind, object, host, guid, detail) of objects and of edges (kind relationship)."""
    every = None
    for kind, df in objects:
        own = df.select("ts", F.lit(kind).alias("kind"), "object", "host", "guid", "detail").where("ts IS NOT NULL")
        every = own if every is None else every.unionByName(own)
    for test in ([F.col("host") == host] if host else []) + ([F.col("ts") >= F.lit(after).cast("timestamp")] if after else []) + ([F.col("ts") < F.lit(before).cast("timestamp")] if before else []):
        every = every.where(test)
    return every.orderBy("ts", F.col("kind") == "relationship", "object", "guid", "detail")
