"""What the data of linked events implies beyond their declared relations, by rules that are data.

Links: two observed rows that share a strong identity, one to one. Actors: the account in whose name a row acted. Inferred
nodes: what rows name by a strong identity and no source observed; they are told apart from events and say what they rest on.
Content nodes: the same bytes, or the same account, wherever they appear.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.blanks import present
from evidentia.operators import graph
from evidentia.plans.links import SCOPE, known, native, prop

#: Texts that are content hashes, identifiers of real accounts, and logon identities that name one session.
HASH, HASH_FIELDS = r"^(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})$", ["sha256_hash", "sha1_hash", "md5_hash"]
SID, SID_FIELDS = r"^S-1-(?:5-21|12-1)-\d+-\d+-\d+-\d+$", ["sid", "uid", "owner_uid", "target_uid"]
LUID = r"(?i)^0x(?!0$|3e4$|3e5$|3e7$)[0-9a-f]+$"
HASH_PROPERTIES = ["file_path", "image_path", "module_path", "file_name", "signer"]
SID_PROPERTIES = ["user", "hostname"]
#: Values of a property that a content node lists.
LISTED = 64


@dataclass(frozen=True)
class Actor:
    kind: str
    action: str | None
    account: list[str]
    relationship: str
    target: list[str] = field(default_factory=list)


#: Which rows name their actor, and the verb of it.
ACTORS = [
    Actor("process", "create", ["sid", "uid"], "created"),
    Actor("user_session", "login", ["uid"], "created"),
    Actor("authentication", None, ["uid"], "attempted to authenticate", ["target_uid"]),
]


@dataclass(frozen=True)
class Missing:
    """A rule for what rows refer to: where the reference is, which link tells that it was observed, and what rows say of it."""

    name: str
    identity: str
    reference: str
    linked: str
    scope: str
    node: str
    end: str
    relationship: str
    method: str
    properties: Mapping[str, str]
    accept: str | None = None
    form: str | None = None
    observed: tuple[str, str] | None = None


#: The references by which a node that nothing observed is inferred.
MISSING = [
    Missing("owning_process", "guid", "owning_guid_native", "owner_guid", "spokes", "process", "source", "spoke_owner", "native_guid", {"pid": "owning_pid", "image_path": "image_path"}),
    Missing("owning_process_memory", "offset", "owning_offset", "owner_guid", "spokes", "process", "source", "spoke_owner", "memory_offset", {"pid": "owning_pid"}, form="proc-{hex}"),
    Missing("parent_process", "guid", "native.ParentProcessGuid", "parent_guid", "process/create", "process", "source", "created", "native_guid", {"pid": "ppid", "image_path": "parent_image_path", "exe": "parent_exe", "command_line": "parent_command_line"}),
    Missing("injection_target", "guid", "native.TargetProcessGuid", "native.target_process_guid", "thread", "process", "target", "accessed", "native_guid", {"pid": "tgt_pid"}, observed=("owner_guid", "process")),
    Missing("auth_session_target", "luid", "native.TargetLogonId", "native.target_session_guid", "authentication/success", "user_session", "target", "created", "luid", {"login_id": "native.TargetLogonId", "user": "target_user", "uid": "target_uid"}, accept=LUID, form="user_session-{value}"),
]


def value_of(rows: DataFrame, name: str) -> Column:
    """A value by where it is: a column of the row, an entry of its native bag, else a field."""
    if name.startswith("native."):
        return native(name.removeprefix("native."))
    if name in rows.columns:
        return F.col(name).cast("string")
    return F.lit(None).cast("string") if name == "owning_offset" else prop(name)


def accepted(value: Column, pattern: str) -> Column:
    trimmed = F.trim(value)
    return F.when(trimmed.rlike(pattern), trimmed)


def first_account(names: list[str]) -> tuple[Column, Column]:
    """The first field with the identifier of a real account, and the identifier."""
    sids = [accepted(prop(n), SID) for n in names]
    return F.coalesce(*(F.when(s.isNotNull(), n) for s, n in zip(sids, names, strict=True))), F.upper(F.coalesce(*sids))


def relation(when: Column, ts: Column, verb: Column, start: tuple[Column, Column], end: tuple[Column, Column], method: str, key: Column, corroborated: Column, confidence: str = "definitive", inferred: Column | None = None) -> Column:
    """A derived relation as a struct; null where ``when`` does not hold or an end is not known."""
    fields = {
        "timestamp": ts, "relationship": verb, "source_object": start[0], "source_guid": start[1], "target_object": end[0], "target_guid": end[1], "source": F.col("source"), "source_host": F.col("source_host"), "class": F.lit("derived"),
        "confidence": F.lit(confidence), "method": F.lit(method), "properties": F.lit(None).cast("string"), "identity_key": key, "inferred_end": (F.lit(None) if inferred is None else inferred).cast("string"), "corroborated_by": corroborated,
    }
    return F.when(when & start[1].isNotNull() & end[1].isNotNull(), F.struct(*(v.alias(k) for k, v in fields.items())))


def actors(rows: DataFrame) -> DataFrame:
    """Relations from accounts to what they did, and from the account of an authentication to its target: a scan."""
    account, kinds = F.lit("user_account"), []
    for a in ACTORS:
        name, sid = first_account(a.account)
        when = (F.col("car_object") == a.kind) & F.col("guid").isNotNull() & (F.lit(True) if a.action is None else F.col("car_action") == a.action)
        end = (F.col("car_object"), F.col("guid"))
        if a.target:
            other = first_account(a.target)[1]
            when, end = when & (other != sid), (account, F.concat(F.lit("sid:"), other))
        kinds.append(relation(when, F.col("ts"), F.lit(a.relationship), (account, F.concat(F.lit("sid:"), sid)), end, "actor_sid", name, F.array("guid")))
    return graph.edges(rows, kinds)


def one_to_one(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows (scope, value, path, ...) with ``other``, the lone right row of their value, or of their value and path if there are several.

    Right rows are counted before they are joined, so no pairs are made of what is ambiguous.
    """
    keys = [*SCOPE, "value"]
    other = F.struct("guid", "ts").alias("other")
    lone = lambda by: right.groupBy(*by).agg(F.count("*").alias("n"), F.min(other).alias("other"))
    whole, narrow = lone(keys).alias("w"), lone([*keys, "path"]).alias("p")
    same = lambda of, by: reduce(lambda x, y: x & y, (F.col(f"l.{k}").eqNullSafe(F.col(f"{of}.{k}")) if k == "source_host" else F.col(f"l.{k}") == F.col(f"{of}.{k}") for k in by))
    met = left.alias("l").join(whole, same("w", keys)).join(narrow, same("p", [*keys, "path"]), "left")
    found = F.when(F.col("w.n") == 1, F.col("w.other")).when(F.col("p.n") == 1, F.col("p.other"))
    return met.select("l.*", found.alias("other")).where("other IS NOT NULL AND other.guid <> guid")


def links(rows: DataFrame) -> DataFrame:
    """Relations between two observed rows: a process and the file of its image by content hash, a request and the files it carried.

    Several rows with the hash are told by the path of the image; what is still ambiguous is not linked. A pair that more than
    one hash links has the strongest one's relation.
    """
    own = rows.where("guid IS NOT NULL")
    scope = [*SCOPE, "guid", "ts"]
    hashes = F.array_compact(F.array(*(F.when(accepted(prop(h), HASH).isNotNull(), F.struct(F.lit(k).alias("rank"), F.lit(h).alias("key"), F.lower(F.trim(prop(h))).alias("hash"))) for k, h in enumerate(HASH_FIELDS))))
    by_hash = lambda kind, path: own.where(F.col("car_object") == kind).select(*scope, F.lower(prop(path)).alias("path"), F.explode(hashes).alias("h")).select(*scope, "path", "h.rank", "h.key", F.concat_ws(":", "h.key", "h.hash").alias("value"))
    image = one_to_one(by_hash("process", "image_path"), by_hash("file", "file_path"))
    strongest = image.groupBy(*scope, "other").agg(F.min(F.struct("rank", "key")).alias("h")).select(*scope, "other", "h.key")
    fuids = F.array_distinct(F.from_json(native("resp_fuids"), "array<string>"))
    asked = own.where("car_object = 'http'").select(*scope, F.lit(None).cast("string").alias("path"), F.explode(fuids).alias("value"))
    files = own.where("car_object = 'file'").select(*scope, F.lit(None).cast("string").alias("path"), F.col("guid").alias("value"))
    carried = one_to_one(asked, files).select(*scope, "other", F.lit("native.resp_fuids").alias("key"))
    edge = lambda start, end, verb, method: relation(F.lit(True), F.coalesce("ts", "other.ts"), F.lit(verb), (F.lit(start), F.col("guid")), (F.lit(end), F.col("other.guid")), method, F.col("key"), F.array("guid", "other.guid"))
    return graph.edges(strongest, [edge("process", "file", "executed", "shared_hash")]).unionByName(graph.edges(carried, [edge("http", "file", "contained", "shared_fuid")]))


def in_scope(scope: str) -> Column:
    if scope == "spokes":
        return F.col("car_object") != "process"
    kind, _, action = scope.partition("/")
    return (F.col("car_object") == kind) & (F.col("car_action") == action if action else F.lit(True))


def references(rows: DataFrame) -> DataFrame:
    """A row for each reference, by a rule, to a node that no row of its source and host is: one scan and one anti-join."""
    kinds = []
    for k, m in enumerate(MISSING):
        told = value_of(rows, m.reference)
        value = present(told) if m.accept is None else accepted(told, m.accept)
        node = value
        if m.form and "{hex}" in m.form:
            node = F.replace(F.lit(m.form), F.lit("{hex}"), F.lower(F.hex(value.try_cast("bigint"))))
        elif m.form:
            node = F.replace(F.lit(m.form), F.lit("{value}"), F.lower(value))
        seen = (F.lit(m.observed[1]), present(value_of(rows, m.observed[0]))) if m.observed else (F.col("car_object"), F.col("guid"))
        verb = graph.verb_of(F.col("car_object"), F.col("car_action")) if m.relationship == "spoke_owner" else F.lit(m.relationship)
        when = in_scope(m.scope) & F.col("guid").isNotNull() & present(value_of(rows, m.linked)).isNull() & (node != F.col("guid")) & seen[1].isNotNull()
        fields = {
            "rule_no": F.lit(k), "rule": F.lit(m.name), "identity": F.lit(m.identity), "identity_value": told, "node": F.lit(m.node), "node_id": node, "end": F.lit(m.end), "verb": verb, "method": F.lit(m.method),
            "seen_object": seen[0], "seen_guid": seen[1], "told": known({n: present(value_of(rows, of)) for n, of in m.properties.items()}),
        }
        kinds.append(F.when(when, F.struct(*(v.alias(n) for n, v in fields.items()))))
    asked = rows.select(*SCOPE, "ts", "timestamp", "row_id", F.explode(F.array_compact(F.array(*kinds))).alias("r")).select(*SCOPE, "ts", "timestamp", "row_id", "r.*")
    observed = rows.where("guid IS NOT NULL").select(*(F.col(c).alias(f"_o_{c}") for c in SCOPE), F.col("car_object").alias("_o_object"), F.col("guid").alias("_o_guid")).distinct()
    same = (F.col("source") == F.col("_o_source")) & F.col("source_host").eqNullSafe(F.col("_o_source_host")) & (F.col("node") == F.col("_o_object")) & (F.col("node_id") == F.col("_o_guid"))
    return asked.join(observed, same, "left_anti")


def inferred_edges(asked: DataFrame) -> DataFrame:
    """The relations that end on inferred nodes."""
    node, seen, first = (F.col("node"), F.col("node_id")), (F.col("seen_object"), F.col("seen_guid")), F.col("end") == "source"
    ends = [tuple(F.when(first, a).otherwise(b) for a, b in zip(x, y, strict=True)) for x, y in ((node, seen), (seen, node))]
    made = relation(F.lit(True), F.col("ts"), F.col("verb"), ends[0], ends[1], "", F.col("identity"), F.array("seen_guid"), "inferred", F.col("end"))
    return graph.edges(asked.withColumn("_m", F.col("method")), [made.withField("method", F.col("_m"))])


def relations(rows: DataFrame) -> DataFrame:
    """All derived relations of linked events."""
    return links(rows).unionByName(actors(rows)).unionByName(inferred_edges(references(rows)))


def inferred_nodes(rows: DataFrame) -> DataFrame:
    """A node for each thing that is referred to and was not observed: which rules and rows it rests on, and what these say of it.

    Of a property the first row's value is kept, by the order of the rules, then of time; all others are listed as conflicts, and
    all rows that it rests on as its corroboration: a node is as long as what refers to it.
    """
    key = [*SCOPE, "node_id"]
    asked = references(rows).withColumn("_at", F.struct("rule_no", "timestamp", "row_id"))
    by_row = asked.groupBy(*key, "seen_guid").agg(F.min("_at").alias("_at"), F.collect_set(F.struct("rule_no", "rule")).alias("rules"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.min_by(F.struct("node", "identity", "identity_value", "method"), "_at").alias("of"))
    # at most one entry a rule in the sets, whatever the number of rows
    rules = F.array_sort(F.array_distinct(F.flatten(F.collect_set("rules"))))
    nodes = by_row.groupBy(*key).agg(rules.alias("rules"), F.count("*").alias("n"), F.min("first").alias("first_seen"), F.max("last").alias("last_seen"), F.min_by("of", "_at").alias("of"))
    said = asked.select(*key, "_at", F.explode("told").alias("property", "value"))
    lists = graph.first_values(said, key, "property", "value", "_at", None)
    seen = graph.first_values(by_row.select(*key, "_at", F.lit("").alias("property"), F.col("seen_guid").alias("value")), key, "property", "value", "_at", None)
    first = F.transform_values("values", lambda k, v: v[0])
    more = F.map_filter(F.transform_values("values", lambda k, v: F.slice(v, F.lit(2), F.size(v))), lambda k, v: F.size(v) > 0)
    said = lists.select(*(F.col(k).alias(f"_s_{k}") for k in key), first.alias("properties"), F.when(F.size(more) > 0, F.to_json(more)).alias("conflicts"))
    seen = seen.select(*(F.col(k).alias(f"_r_{k}") for k in key), F.try_element_at("values", F.lit("")).alias("corroborated_by"))
    on = lambda p: reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"{p}{k}")) for k in key))
    out = nodes.join(said, on("_s_"), "left").join(seen, on("_r_"), "left")
    reason = F.concat(
        F.array_join(F.transform("rules", lambda r: r["rule"]), "+"), F.lit(": referenced by "), F.col("n"), F.lit(" observed record(s) via "), F.col("of.identity"),
        F.lit("; no "), F.col("of.node"), F.lit(" event observed (reconstructed, not evidence)"),
    )
    return out.select(
        *SCOPE, "node_id", F.col("of.node").alias("object"), F.col("of.identity").alias("identity_key"), F.col("of.identity_value").alias("identity_value"), reason.alias("reason"), F.col("of.method").alias("method"),
        "corroborated_by", F.coalesce("properties", F.create_map().cast("map<string,string>")).alias("properties"), "conflicts", "first_seen", "last_seen",
    )


def content_references(rows: DataFrame) -> DataFrame:
    """A row for each content identity that an event carries, with the field that tells its role: hashes and real accounts."""
    fields = [(k, f, HASH, "file_content", f.removesuffix("_hash"), F.lower) for k, f in enumerate(HASH_FIELDS)] + [(10 + k, f, SID, "user_account", "sid", F.upper) for k, f in enumerate(SID_FIELDS)]
    refs = []
    for no, name, pattern, kind, prefix, fold in fields:
        value = fold(accepted(prop(name), pattern))
        refs.append(F.when(value.isNotNull(), F.struct(F.concat(F.lit(f"{prefix}:"), value).alias("node_id"), F.lit(kind).alias("kind"), F.lit(name).alias("identity_key"), value.alias("identity_value"), F.lit(no).alias("no"))))
    told = F.create_map(*(F.lit(x) for kind, names in (("file_content", HASH_PROPERTIES), ("user_account", SID_PROPERTIES)) for x in (kind, ",".join(names))))
    wide = rows.select(*SCOPE, "ts", "timestamp", "row_id", "car_object", "guid", "props", F.explode(F.array_compact(F.array(*refs))).alias("r")).select("*", "r.*").drop("r")
    names = F.split(F.try_element_at(told, "kind"), ",")
    return wide.withColumn("told", F.map_filter("props", lambda k, v: F.array_contains(names, k) & (v != ""))).drop("props")


def content_nodes(rows: DataFrame) -> DataFrame:
    """A node for each hash and account: references, first and last time, and the first values of its properties, LISTED at most of each."""
    refs = content_references(rows).withColumn("_at", F.struct("timestamp", "row_id", "no"))
    nodes = refs.groupBy("node_id", "kind", "identity_value").agg(F.min_by("identity_key", "_at").alias("identity_key"), F.count("*").alias("ref_count"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    lists = graph.first_values(refs.select("node_id", "_at", F.explode("told").alias("property", "value")), ["node_id"], "property", "value", "_at", LISTED)
    return nodes.join(lists.withColumnRenamed("values", "properties"), "node_id", "left")


def entity_references(rows: DataFrame) -> DataFrame:
    """Which events carry which content node, by role: each once."""
    keys = [*SCOPE, "car_object", "guid", "node_id", "identity_key"]
    return content_references(rows).where("guid IS NOT NULL").groupBy(*keys).agg(F.min("ts").alias("ts"))
