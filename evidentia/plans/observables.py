"""Observables of linked events in the terms of the exchange standard: values, accounts and file contents with its identities.

An identity is a version 5 UUID. What is the same everywhere, an address, a name, an account of a domain, the bytes of a file, has
the standard's own; an account that only its host knows has one of the case.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions.blanks import present
from evidentia.operators import fold, graph
from evidentia.plans import derived
from evidentia.plans.links import SCOPE, prop
from evidentia.plans.tables import written

#: Fixed value: the standard's namespace of identities over contents (STIX 2.1, section 2.9).
STANDARD = uuid.UUID("00abedb4-aa42-466c-9c01-fed23315a9b7")
#: The fields of events that name a value, by the kind of its observable.
ADDRESSES = ["src_ip", "dest_ip", "requester_ip_address", "local_address", "remote_address"]
VALUES = {
    "domain-name": ["src_fqdn", "dest_fqdn", "url_domain", "src_domain"],
    "url": ["url_full"],
    "email-addr": ["src_address", "dest_address", "return_address"],
}
#: The accounts that events name, by their objects: the identifier, by the first field that has one, and the name.
ACCOUNTS = [
    (["process"], ["sid", "uid"], "user"), (["file", "service", "thread", "authentication", "user_session"], ["uid"], "user"), (["registry"], [], "user"),
    (["authentication"], ["target_uid"], "target_user"), (["file"], ["owner_uid"], "owner"),
]
#: Hash algorithms in the order in which one of them names the contents of a file.
ALGORITHMS = {"md5": "MD5", "sha1": "SHA-1", "sha256": "SHA-256"}


def global_id(kind: str | Column, contributing: Column) -> Column:
    """The standard's identity over the contributing properties, a canonical JSON text."""
    name = kind if isinstance(kind, Column) else F.lit(kind)
    return F.concat(name, F.lit("--"), ids.uuid5(contributing, STANDARD))


def case_id(case: str, kind: str, *parts: Column) -> Column:
    key = F.concat_ws("|", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.concat(F.lit(f"{kind}--"), ids.uuid5(key, uuid.uuid5(ids.NAMESPACE, f"case|{case}")))


def value_references(rows: DataFrame) -> DataFrame:
    """(source, source_host, guid, ts, kind, value, role): each value that an event names, one scan."""
    told = []
    for field in ADDRESSES:
        value = F.trim(prop(field))
        kind = F.when(F.contains(value, F.lit(":")), "ipv6-addr").otherwise("ipv4-addr")
        told.append(F.when(ids.is_ip(value), F.struct(kind.alias("kind"), F.lower(value).alias("value"), F.lit(field).alias("role"))))
    for kind, fields in VALUES.items():
        told += [F.when(F.trim(prop(f)) != "", F.struct(F.lit(kind).alias("kind"), F.trim(prop(f)).alias("value"), F.lit(f).alias("role"))) for f in fields]
    return rows.select(*SCOPE, "guid", "ts", F.explode(F.array_compact(F.array(*told))).alias("v")).select(*SCOPE, "guid", "ts", "v.*")


def value_observables(rows: DataFrame) -> DataFrame:
    """(id, kind, value, roles, observations, first_seen, last_seen): one for each different value, whatever names it."""
    found = value_references(rows).groupBy("kind", "value").agg(F.array_sort(F.collect_set("role")).alias("roles"), F.count("*").alias("observations"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    return found.select(global_id(F.col("kind"), ids.canonical_json({"value": F.col("value")})).alias("id"), *found.columns)


def accounts(rows: DataFrame, case: str) -> DataFrame:
    """(id, fields, conflicts): accounts put together from all events that name them.

    A real account's identity is over its identifier alone, and it has that and a displayed name; any other has one of its host,
    over its identifier or, without one, its name. Names that differ are conflicts.
    """
    told = []
    for kinds, fields, name in ACCOUNTS:
        identifier, called = F.coalesce(F.lit(None).cast("string"), *(present(F.trim(prop(f))) for f in fields)), present(prop(name))
        told.append(F.when(F.col("car_object").isin(kinds) & (identifier.isNotNull() | called.isNotNull()), F.struct(identifier.alias("sid"), called.alias("name"))))
    every = rows.select("source_host", F.struct("timestamp", "row_id").alias("at"), F.explode(F.array_compact(F.array(*told))).alias("a")).select("source_host", "at", "a.*")
    real = F.upper(derived.accepted(F.col("sid"), derived.SID))
    own = F.when(F.col("sid").isNotNull(), case_id(case, "user-account", F.col("source_host"), F.lit("id"), F.col("sid"))).otherwise(case_id(case, "user-account", F.col("source_host"), F.lit("name"), F.col("name")))
    keyed = every.withColumn("real", real).withColumn("id", F.coalesce(global_id("user-account", ids.canonical_json({"user_id": F.col("real")})), own))
    entry = lambda name, value: F.struct(F.lit(name).alias("field"), value.alias("value"), F.lit(False).alias("listed"))
    known = F.col("real").isNotNull()
    fields = F.array(
        entry("user_id", F.coalesce("real", "sid")), entry("display_name", F.when(known, F.col("name"))), entry("account_login", F.when(~known, F.col("name"))), entry("x_source_host", F.when(~known, F.col("source_host"))),
    )
    return fold.documents(keyed.select("id", "at", F.explode(fields).alias("f")).select("id", "at", "f.*"), "id", "field", "value", "at")


def content_files(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """File contents (id, hashes, conflicts) and (node_id, id) of the hash nodes that are one.

    Hashes that an event has together are of the same bytes, and so are hashes that share one. Of each algorithm the smallest
    value stays, others are conflicts. The identity is over the first algorithm that there is, MD5 before the SHA family.
    """
    refs = derived.content_references(rows).where("kind = 'file_content'")
    by_event = refs.where("guid IS NOT NULL").groupBy(*SCOPE, "car_object", "guid", "node_id").agg(F.min("row_id").alias("row_id"))
    least = by_event.groupBy(*SCOPE, "car_object", "guid").agg(F.min("node_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    keys = [*SCOPE, "car_object", "guid"]
    same = F.lit(True)
    for k in keys:
        same = same & by_event[k].eqNullSafe(least[k])
    links = by_event.join(least, same).where("node_id <> least").select(F.col("least").alias("a"), F.col("node_id").alias("b")).distinct()
    nodes = written(refs.groupBy("node_id").agg(F.min("identity_value").alias("value")))
    one = graph.components(nodes.select(F.col("node_id").alias("id")), links, written).select(F.col("id").alias("node_id"), "component")
    placed = nodes.join(one, "node_id").withColumn("algorithm", F.split_part("node_id", F.lit(":"), F.lit(1)))
    entries = placed.select("component", "algorithm", "value", F.lit(False).alias("listed"))
    files = fold.documents(entries.withColumn("at", F.col("value")), "component", "algorithm", "value", "at")
    of = lambda a: F.try_element_at("fields", F.lit(a))[0]
    named = F.coalesce(*(F.when(of(a).isNotNull(), F.to_json(F.struct(F.struct(of(a).alias(name)).alias("hashes")))) for a, name in ALGORITHMS.items()))
    found = written(files.select("component", global_id("file", named).alias("id"), F.transform_values("fields", lambda k, v: v[0]).alias("hashes"), "conflicts"))
    return found.drop("component"), placed.join(found.select("component", "id"), "component").select("node_id", "id")
