"""A case as objects of the exchange standard: the things that events are about, observations, relations, inferred nodes, sightings.

What an event tells of each thing is declared as data, a list of things for each event object. Things are known by keys, texts
that tell them apart; a key becomes an identity only on the way out, when all that events say of a thing is one document. Keys
that start with ``=`` are over contents alone and have the standard's own identity, others one of the case.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass, field
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions.blanks import present
from evidentia.functions.markers import hex_int
from evidentia.functions.times import iso_z, parse_ts
from evidentia.operators import fold, joins
from evidentia.plans import derived, observables
from evidentia.plans.links import SCOPE, prop
from evidentia.plans.tables import written

VERSION = "2.1"
#: Confidence words as the standard's numbers; hash fields with the standard's names, the first one names a row's contents.
CONFIDENCE = {"definitive": 100, "heuristic": 50, "inferred": 20}
HASHES = {"md5_hash": "MD5", "sha1_hash": "SHA-1", "sha256_hash": "SHA-256"}
#: Levels of integrity that the standard has, and how its objects are called that stand for an event object.
INTEGRITY = ["low", "medium", "high", "system"]
STANDS_FOR = {
    "authentication": "user-account", "driver": "file", "email": "email-message", "file": "file", "flow": "network-traffic", "http": "network-traffic", "module": "file",
    "process": "process", "registry": "windows-registry-key", "service": "process", "socket": "network-traffic", "thread": "x-thread", "user_session": "user-account",
}
#: Relations end on the observation of an event of these, on the thing itself of any other.
OCCURRENCES = ["authentication", "user_session"]
#: Properties that are not texts.
NUMBERS = ["pid", "x_ppid", "x_parent.pid", "src_port", "dst_port", "src_byte_count", "dst_byte_count", "size", "x_response_body_bytes", "extensions.http-request-ext.message_body_length"]
BOOLEANS = ["is_active", "is_multipart", "extensions.socket-ext.is_listening"]
#: Fields that list values, by event object: the kind of the values, and the field.
LISTING = {"email": [("email-addr", "to"), ("url", "message_links")]}
LISTS = ["protocols", "values", "to_refs", "x_link_refs"]


def host() -> Column:
    return F.col("source_host")


def guid() -> Column:
    return F.col("guid")


def owner() -> Column:
    return F.col("owner_guid")


def parent() -> Column:
    return F.col("parent_guid")


# -- keys and identities ----------------------------------------------------------------------------------------------------


def scoped(kind: str, *parts: Column | str) -> Column:
    return F.concat_ws("|", F.lit(kind), *(F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts))


def worldwide(kind: Column | str, contributing: Column) -> Column:
    return F.concat(F.lit("="), F.lit(kind) if isinstance(kind, str) else kind, F.lit("|"), contributing)


def identity(key: Column, case: str) -> Column:
    """The identity that a key stands for; identities stay as they are."""
    wide = key.startswith("=")
    space = F.when(wide, F.unhex(F.lit(observables.STANDARD.hex))).otherwise(F.unhex(F.lit(uuid.uuid5(ids.NAMESPACE, f"case|{case}").hex)))
    name = F.when(wide, F.regexp_replace(key, "^[^|]*[|]", "")).otherwise(key)
    made = ids.uuid_of_sha1(F.sha1(F.concat(space, F.encode(name, "UTF-8"))))
    return F.when(F.contains(key, F.lit("|")), F.concat(F.regexp_extract(key, "^=?([^|]*)", 1), F.lit("--"), made)).otherwise(key)


# -- what events tell -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Told:
    """A field that a property takes over; null where the field has nothing or the property can not hold it."""

    name: str
    value: Column

    def when(self, test: Column) -> Told:
        return Told(self.name, F.when(test, self.value))

    def lower(self) -> Told:
        return Told(self.name, F.lower(self.value))


def text(name: str) -> Told:
    return Told(name, present(prop(name)))


def number(name: str) -> Told:
    return Told(name, hex_int(prop(name)).cast("string"))


def instant(name: str) -> Told:
    return Told(name, iso_z(parse_ts(prop(name))))


@dataclass(frozen=True)
class Thing:
    """A thing that an event tells of. ``ends`` are the (object, guid) pairs under which relations know it."""

    kind: str
    key: Column
    properties: Mapping[str, Told | Column] = field(default_factory=dict)
    role: str | None = None
    takes: tuple[Told, ...] = ()
    ends: tuple[Column | str, Column] | None = None

    def told(self) -> list[Told]:
        return [*self.takes, *(v for v in self.properties.values() if isinstance(v, Told))]


def value(kind: Column | str, said: Told, role: str | None = None, of: Column | None = None) -> Thing:
    """A value that is the same everywhere; ``of`` in place of the field's text, with white space cut off."""
    v = present(F.trim(said.value if of is None else of))
    return Thing(kind if isinstance(kind, str) else "ip", worldwide(kind, ids.canonical_json({"value": v})), {"value": v}, role or said.name, (said,))


def address(name: str) -> Thing:
    v = F.lower(F.trim(prop(name)))
    kind = F.when(F.contains(v, F.lit(":")), "ipv6-addr").otherwise("ipv4-addr")
    return value(kind, Told(name, F.when(ids.is_ip(v), v)))


def account(identifiers: Iterable[str], name: str) -> Thing:
    """An account by its identifier, everywhere if it is a real one, else on its host; by its name if it has no other."""
    named, asked = text(name), [Told(i, present(F.trim(prop(i)))) for i in identifiers]
    sid = F.coalesce(*(a.value for a in asked)) if asked else F.lit(None).cast("string")
    real = F.upper(derived.accepted(sid, derived.SID))
    own = F.when(sid.isNotNull(), scoped("user-account", host(), "id", sid)).when(named.value.isNotNull(), scoped("user-account", host(), "name", named.value))
    properties = {
        "user_id": F.coalesce(real, sid), "display_name": F.when(real.isNotNull(), named.value), "account_login": F.when(real.isNull(), named.value), "x_source_host": F.when(real.isNull(), host()),
    }
    # of several identifiers the first one that there is names the account, and only it is taken over
    first = [Told(a.name, F.when(sid == a.value, a.value)) for a in asked]
    key = F.coalesce(worldwide("user-account", ids.canonical_json({"user_id": real})), own)
    return Thing("user-account", key, properties, asked[0].name if asked else name, (*first, named), ("user_account", F.concat(F.lit("sid:"), real)))


def hashes() -> dict[str, Told]:
    return {f"hashes.{name}": Told(f, F.lower(derived.accepted(prop(f), derived.HASH))) for f, name in HASHES.items()}


def file_at(path: Told | None, name: Told | None, role: str | None, fallback: tuple[Column | str, ...], hashed: bool = False, **more: Told) -> list[Thing]:
    """A file at a path of a host, and its folder; known by its path, else its name, else by the row that has its contents."""
    none = Told("", F.lit(None).cast("string"))
    path, name = path or none, name or none
    properties: dict[str, Told | Column] = {**(hashes() if hashed else {}), **more}
    has_more = reduce(lambda a, b: a | b, (t.value.isNotNull() for t in properties.values()), F.lit(False))
    row = F.when(has_more & fallback[-1].isNotNull(), scoped("file", host(), "row", *fallback))
    key = F.when(path.value.isNotNull(), scoped("file", host(), "path", path.value)).when(name.value.isNotNull(), scoped("file", host(), "name", name.value)).otherwise(row)
    cut = F.regexp_replace(path.value, r"[/\\]+$", "")
    folder = F.regexp_extract(cut, r"(?s)^(.*)[/\\][^/\\]+$", 1)
    folder = F.when(folder != "", folder).when(cut.rlike("^/[^/\\\\]+$"), "/")
    # null without a folder, which is written once
    inside = F.concat(scoped("directory", host(), ""), folder)
    called = F.coalesce(name.value, present(F.regexp_extract(cut, r"([^/\\]*)$", 1)))
    if hashed:
        properties["x_content_ref"] = F.col("content_ref")
    properties |= {"name": called, "x_path": path.value, "parent_directory_ref": inside, "x_source_host": host()}
    return [Thing("file", key, properties, role, (path, name)), Thing("directory", inside, {"path": folder})]


def process(of: Column, role: str | None, properties: Mapping[str, Told | Column], path: Told | None = None, name: Told | None = None, hashed: bool = False, **image: Told) -> list[Thing]:
    """A process, whatever row names it, and the file of its image."""
    files = file_at(path, name, None, ("process", of), hashed, **image) if path or name else []
    said = dict(properties) | {"x_entity_id": of.cast("string"), "x_source_host": host()} | ({"image_ref": files[0].key} if files else {})
    there = lambda t: Thing(t.kind, F.when(of.isNotNull(), t.key), t.properties, t.role, tuple(x.when(of.isNotNull()) for x in t.takes), t.ends)
    whole = {k: v.when(of.isNotNull()) if isinstance(v, Told) else v for k, v in said.items()}
    return [Thing("process", F.when(of.isNotNull(), scoped("process", host(), of)), whole, role, (), ("process", of)), *map(there, files)]


def traffic(kind: str, source: Thing, target: Thing, properties: Mapping[str, Told | Column]) -> list[Thing]:
    key = F.when(guid().isNotNull(), scoped("network-traffic", host(), kind, guid()))
    return [Thing("network-traffic", key, {"src_ref": source.key, "dst_ref": target.key, "x_object": F.lit(kind), "x_source_host": host(), **properties}, kind), source, target]


def listed(name: str) -> Column:
    """The values that a field lists."""
    parts = F.split(F.regexp_replace(prop(name), r'^\[|\]$|"', ""), "[;,]")
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def listed_keys(kind: str, name: str) -> Column:
    return F.transform(listed(name), lambda x: worldwide(kind, F.to_json(F.struct(x.alias("value")))))


def listed_things(kind: str, name: str) -> Column:
    """Each value of a field that lists some, as a thing."""
    none = F.lit(None).cast("string")
    of = lambda x: F.struct(worldwide(kind, F.to_json(F.struct(x.alias("value")))).alias("key"), F.lit(name).alias("role"), F.lit(99).alias("rank"), none.alias("end_object"), none.alias("end_guid"), F.create_map(F.lit("value"), F.array(x)).alias("told"))
    return F.coalesce(F.transform(listed(name), of).cast(f"array<{STORED}>"), F.array().cast(f"array<{STORED}>"))


def signed() -> dict[str, Told]:
    return {"x_signer": text("signer"), "x_signature_valid": text("signature_valid")}


def things() -> dict[str, list[Thing]]:
    """The things that an event of each object tells of; the first that there is stands for the event."""
    action = F.col("car_action")
    out: dict[str, list[Thing]] = {}

    user = account(["sid", "uid"], "user")
    integrity = F.when(F.lower(prop("integrity_level")).isin(INTEGRITY), F.lower(prop("integrity_level")))
    apart = lambda t: t.when(parent().isNull())
    known = {
        "pid": number("pid"), "command_line": text("command_line"), "cwd": text("current_working_directory"), "created_time": F.when(action == "create", iso_z(F.col("ts"))),
        "extensions.windows-process-ext.integrity_level": Told("integrity_level", integrity), "creator_user_ref": user.key, "parent_ref": F.when(parent().isNotNull(), scoped("process", host(), parent())),
        "x_parent.pid": apart(number("ppid")), "x_parent.image_path": apart(text("parent_image_path")), "x_parent.exe": apart(text("parent_exe")), "x_parent.command_line": apart(text("parent_command_line")),
    }
    accessed = F.when(action == "access", present(prop("target_guid")))
    out["process"] = [
        *process(F.coalesce(owner(), guid()), "process", known, text("image_path"), text("exe"), True, **signed()), user,
        *process(parent(), None, {"pid": number("ppid"), "command_line": text("parent_command_line")}, text("parent_image_path"), text("parent_exe")),
        *process(accessed, "target_guid", {"pid": number("target_pid")}, text("target_name")),
    ]

    out["file"] = [*file_at(text("file_path"), text("file_name"), "file", ("file", guid()), True, ctime=instant("creation_time"), mime_type=text("mime_type"), **signed()), account(["owner_uid"], "owner"), account(["uid"], "user")]
    out["module"] = file_at(text("module_path"), text("module_name"), "module", ("module", guid()), True, x_base_address=text("base_address"), **signed())
    out["driver"] = file_at(text("image_path"), text("module_name"), "driver", ("driver", guid()), True, x_base_address=text("base_address"), **signed())

    by = account([], "user")
    typed = Told("type", F.when(F.upper(prop("type")).startswith("REG_"), F.upper(prop("type"))))
    entry, data = text("value"), text("data")
    held = F.when(entry.value.isNotNull() | data.value.isNotNull(), F.to_json(F.struct(entry.value.alias("name"), data.value.alias("data"), typed.value.alias("data_type"))))
    key = F.when(text("key").value.isNotNull(), scoped("windows-registry-key", host(), "key", prop("key"))).when(guid().isNotNull(), scoped("windows-registry-key", host(), "row", guid()))
    out["registry"] = [Thing("windows-registry-key", key, {"key": text("key"), "values": held, "creator_user_ref": by.key, "x_source_host": host()}, "registry", (entry, data, typed.when(held.isNotNull()))), by]

    end = instant("end_time")
    spoken = [text("transport_protocol").lower(), text("application_protocol").lower()]
    protocols = F.array_compact(F.array(*(t.value for t in spoken)))
    out["flow"] = traffic(
        "flow", address("src_ip"), address("dest_ip"),
        {
            "protocols": F.when(F.size(protocols) > 0, protocols).otherwise(F.array(F.lit("ip"))), "src_port": number("src_port"), "dst_port": number("dest_port"), "src_byte_count": number("out_bytes"),
            "dst_byte_count": number("in_bytes"), "start": instant("start_time"), "end": end, "is_active": F.when(end.value.isNotNull(), "false"), "transport": spoken[0], "application": spoken[1],
        },
    )
    family = Told("family", F.when(F.upper(prop("family")).startswith("AF_"), F.upper(prop("family"))))
    out["socket"] = traffic(
        "socket", address("local_address"), address("remote_address"),
        {
            "protocols": F.array(F.coalesce(text("protocol").lower().value, F.lit("ip"))), "application": text("protocol"), "src_port": number("local_port"), "dst_port": number("remote_port"),
            "extensions.socket-ext.address_family": family, "extensions.socket-ext.is_listening": F.when(family.value.isNotNull(), (action == "listen").cast("string")),
        },
    )
    url, rest, domain, scheme = value("url", text("url_full")), text("url_remainder"), value("domain-name", text("url_domain")), text("url_scheme").lower()
    request = F.coalesce(rest.value, text("url_full").value)
    asked = lambda t: t.when(request.isNotNull())
    out["http"] = [
        *traffic(
            "http", address("requester_ip_address"), domain,
            {
                "protocols": F.array(F.lit("tcp"), F.when(scheme.value == "https", "https").otherwise("http")), "scheme": scheme, "x_url_ref": url.key, "x_response_status_code": text("response_status_code"),
                "x_response_body_bytes": number("response_body_bytes"), "extensions.http-request-ext.request_method": F.when(request.isNotNull(), F.lower(action)), "extensions.http-request-ext.request_value": request, "remainder": rest,
                "extensions.http-request-ext.request_version": asked(text("http_version")), "extensions.http-request-ext.message_body_length": asked(number("request_body_bytes")),
                "extensions.http-request-ext.request_header.User-Agent": asked(text("user_agent_full")), "extensions.http-request-ext.request_header.Referer": asked(text("request_referrer")),
                "extensions.http-request-ext.request_header.Host": F.when(request.isNotNull(), text("url_domain").value),
            },
        ),
        url,
    ]
    out["authentication"] = [account(["target_uid"], "target_user"), account(["uid"], "user")]
    out["user_session"] = [account(["uid"], "user"), address("src_ip"), address("dest_ip")]

    name, user = text("name"), account(["uid"], "user")
    image = file_at(text("image_path"), text("exe"), None, ("service", guid()))
    key = F.when(name.value.isNotNull(), scoped("process", host(), "service", name.value)).when(guid().isNotNull(), scoped("process", host(), "row", "service", guid()))
    said = {"x_object": F.lit("service"), "command_line": text("command_line"), "pid": number("pid"), "creator_user_ref": user.key, "image_ref": image[0].key, "extensions.windows-service-ext.service_name": name, "x_source_host": host()}
    out["service"] = [Thing("process", key, said, "service"), user, *image]

    start, user = file_at(text("start_module"), None, None, ("thread", guid())), account(["uid"], "user")
    told = ["src_pid", "src_tid", "tgt_pid", "tgt_tid", "start_address", "start_function", "start_module_name", "stack_base", "stack_limit", "user_stack_base", "user_stack_limit"]
    said = {f: text(f) for f in told} | {"start_module_ref": start[0].key, "creator_user_ref": user.key, "x_source_host": host()}
    out["thread"] = [Thing("x-thread", F.when(guid().isNotNull(), scoped("x-thread", host(), guid())), said, "thread"), *start, user]

    sender, back = value("email-addr", text("from")), value("email-addr", text("return_address"))
    attached = file_at(None, text("attachment_name"), "attachment_name", ("email", guid()), mime_type=text("attachment_mime_type").when(text("attachment_name").value.isNotNull()), size=number("attachment_size").when(text("attachment_name").value.isNotNull()))
    said = {
        "is_multipart": F.lit("false"), "from_ref": sender.key, "sender_ref": back.key, "subject": text("subject"), "date": instant("date"), "body": text("message_body"), "to_refs": listed_keys("email-addr", "to"), "to": text("to"), "x_link_refs": listed_keys("url", "message_links"),
        "links": text("message_links"), "x_attachment_ref": attached[0].key, "x_source_host": host(),
    }
    out["email"] = [Thing("email-message", F.when(guid().isNotNull(), scoped("email-message", host(), guid())), said, "email"), sender, back, *attached, address("src_ip"), address("dest_ip")]

    acting = {
        "driver": (["pid"], None, None), "file": (["pid", "ppid"], "image_path", None), "flow": (["pid", "ppid"], "image_path", "exe"), "module": (["pid"], "image_path", None),
        "registry": (["pid"], "image_path", None), "socket": (["pid"], "image_path", None), "thread": (["src_pid"], None, None),
    }
    for kind in out:
        if kind != "process":
            numbers, path, exe = acting.get(kind, ([], None, None))
            said = {"x_ppid" if n == "ppid" else "pid": number(n) for n in numbers}
            out[kind] += process(owner(), "owning_guid", said, text(path) if path else None, text(exe) if exe else None)
    return out


#: Names under which a thing keeps what it takes over in another form: homed, not written.
SHOWN_OTHERWISE = ["transport", "application", "scheme", "remainder", "to", "links"]
STORED = "struct<key:string,role:string,rank:int,end_object:string,end_guid:string,told:map<string,array<string>>>"
REFERENCES = STORED.replace(",told:map<string,array<string>>", "")


def stored(kind: str, n: int, thing: Thing, properties: bool) -> Column:
    """A thing as a struct; its key is null where the event does not tell of it."""
    entries = []
    for name, said in thing.properties.items() if properties else ():
        if name not in SHOWN_OTHERWISE:
            v = said.value if isinstance(said, Told) else said
            entries += [F.lit(name), v if name in ("protocols", "to_refs", "x_link_refs") else F.array(v.cast("string"))]
    ends = thing.ends or (None, F.lit(None))
    # the first thing stands for the event; a process that another event names, and an account, for itself
    own = n == 0 and kind not in OCCURRENCES and thing.ends is None
    first, second = (F.lit(kind), guid()) if own else (F.lit(ends[0]), ends[1])
    fields = [thing.key.alias("key"), F.lit(thing.role).alias("role"), F.lit(n).alias("rank"), first.alias("end_object"), second.cast("string").alias("end_guid")]
    return F.struct(*fields, F.create_map(*entries).alias("told")).cast(STORED) if properties else F.struct(*fields).cast(REFERENCES)


def event_objects(rows: DataFrame) -> list[str]:
    """The event objects that rows have, for ``prepared``: what is declared of others need not be planned. Reads one column."""
    return sorted(r[0] for r in rows.where(F.col("car_object").isin(list(things()))).select("car_object").distinct().collect())


def prepared(rows: DataFrame, contents: DataFrame | None = None, kinds: Collection[str] | None = None, properties: bool = True) -> DataFrame:
    """Linked events with their things, what no thing takes over, and the contents that their hashes are of; a written table.

    ``contents`` are the (node_id, id) pairs of ``observables.content_files``. ``kinds`` are the event objects that the rows can
    have, by default all. Without ``properties`` things have their keys, roles and ends only: enough for references and
    relations, not for objects and for the fields of observations.
    """
    for name in ("owner_guid", "parent_guid", "link_confidence"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    spec = {k: v for k, v in things().items() if kinds is None or k in kinds} or {"file": things()["file"]}
    rows = rows.where(F.col("car_object").isin(list(spec)))
    accepted = {f.removesuffix("_hash"): F.lower(derived.accepted(prop(f), derived.HASH)) for f in HASHES}
    rows = rows.withColumn("node", F.coalesce(*(F.concat(F.lit(f"{a}:"), v) for a, v in accepted.items())))
    # rows without a hash stay out of the join, so that they are not one large key
    plain, hashed = rows.where("node IS NULL").withColumn("content_ref", F.lit(None).cast("string")), rows.where("node IS NOT NULL")
    found = contents if contents is not None else observables.content_files(rows)[1]
    hashed = hashed.join(found.select(F.col("node_id").alias("node"), F.col("id").alias("content_ref")), "node", "left")
    every = plain.unionByName(hashed.select(*plain.columns)).drop("node")
    lists, homes, form = [], [], STORED if properties else REFERENCES
    for kind, own in spec.items():
        listed = [listed_things(*x) for x in LISTING.get(kind, [])]
        if properties:
            every_thing = F.concat(F.array(*(stored(kind, n, t, True) for n, t in enumerate(own))), *listed)
        else:
            # each thing that there is, without a function over the entries of an array, which has no generated code
            there = [F.when(t.key.isNotNull(), F.array(stored(kind, n, t, False))).otherwise(F.array().cast(f"array<{form}>")) for n, t in enumerate(own)]
            every_thing = F.concat(*there, *(F.transform(x, lambda t: t.dropFields("told").cast(form)) for x in listed))
        lists.append(F.when(F.col("car_object") == kind, every_thing))
        homes.append(F.when(F.col("car_object") == kind, F.array(*(F.when(t.value.isNotNull(), F.lit(t.name)) for thing in own for t in thing.told()))))
    made = F.coalesce(*lists)
    record = [scoped("x-record", host(), F.col("car_object"), guid()).alias("key"), F.col("car_object").alias("role"), F.lit(0).alias("rank"), F.col("car_object").alias("end_object"), guid().cast("string").alias("end_guid")]
    if properties:
        there = F.filter(made, lambda t: t["key"].isNotNull())
        # of what is told only what there is
        made = F.transform(there, lambda t: F.struct(*(t[c].alias(c) for c in ("key", "role", "rank", "end_object", "end_guid")), F.map_filter(t["told"], lambda k, v: F.size(F.array_compact(v)) > 0).alias("told")))
        said = F.create_map(F.lit("x_object"), F.array("car_object"), F.lit("x_event_id"), F.array("guid"), F.lit("x_source_host"), F.array("source_host"))
        record.append(F.map_filter(said, lambda k, v: F.size(F.array_compact(v)) > 0).alias("told"))
        every = every.withColumn("homed", F.array_compact(F.coalesce(*homes)))
    out = every.withColumn("things", made)
    own = F.exists("things", lambda t: F.coalesce(t["role"] != "owning_guid", F.lit(True)))
    out = out.withColumn("things", F.when(own | guid().isNull(), F.col("things")).otherwise(F.concat(F.array(F.struct(*record).cast(form)), F.col("things"))))
    return written(out)


# -- objects ----------------------------------------------------------------------------------------------------------------


def objects(ready: DataFrame, case: str, contents: DataFrame | None = None) -> DataFrame:
    """(id, kind, fields, conflicts): everything that events tell of, each thing put together from all rows that name it.

    The first row's value fills a property, lists are united, and what other rows say otherwise is a conflict. ``contents`` are
    the files of ``observables.content_files``, which have their hashes only.
    """
    each = ready.select("timestamp", "row_id", F.explode("things").alias("t"))
    entries = each.select(F.col("t.key").alias("key"), "timestamp", "row_id", F.explode("t.told").alias("field", "said")).select("key", "field", "timestamp", "row_id", F.posexplode("said").alias("place", "value"))
    entries = entries.select("key", "field", "value", F.struct("timestamp", "row_id", "place").alias("at"), F.col("field").isin(LISTS).alias("listed"))
    whole = fold.documents(entries, "key", "field", "value", "at")
    refer = lambda m: F.transform_values(m, lambda k, v: F.when(k.endswith("_ref") | k.endswith("_refs"), F.transform(v, lambda x: identity(x, case))).otherwise(v))
    out = whole.select(identity(F.col("key"), case).alias("id"), refer(F.col("fields")).alias("fields"), refer(F.col("conflicts")).alias("conflicts"))
    if contents is not None:
        names = F.create_map(*(F.lit(x) for f, name in HASHES.items() for x in (f.removesuffix("_hash"), f"hashes.{name}")))
        told = F.map_from_entries(F.transform(F.map_entries("hashes"), lambda e: F.struct(F.try_element_at(names, e["key"]), F.array(e["value"]))))
        out = out.unionByName(contents.select("id", told.alias("fields"), F.create_map().cast("map<string,array<string>>").alias("conflicts")))
    return out.select("id", F.regexp_extract("id", "^(.*)--", 1).alias("kind"), "fields", "conflicts")


def observations(ready: DataFrame, case: str) -> DataFrame:
    """One observation for each event that has an identity and a time: what it refers to and in which roles, and all it says that no thing has.

    Nothing is shuffled: an event's references are made of its own row.
    """
    seen = ready.where("guid IS NOT NULL AND ts IS NOT NULL")
    hashed = [F.when(derived.accepted(prop(f), derived.HASH).isNotNull(), F.lit(f)) for f in HASHES]
    content = F.when(F.col("content_ref").isNotNull(), F.transform(F.array_compact(F.array(*hashed)), lambda f: F.struct(F.col("content_ref").alias("id"), f.alias("role"))))
    refs = F.concat(F.transform("things", lambda t: F.struct(identity(t["key"], case).alias("id"), t["role"].alias("role"))), F.coalesce(content, F.array().cast("array<struct<id:string,role:string>>")))
    out = seen.withColumn("refs", refs).withColumn("object_refs", F.array_distinct(F.transform("refs", lambda r: r["id"])))
    roles = lambda i: F.array_distinct(F.array_compact(F.transform(F.filter("refs", lambda r: r["id"] == i), lambda r: r["role"])))
    acting = F.coalesce(owner(), F.when(F.col("car_object") == "process", guid()))
    key = scoped("observed-data", F.col("source"), host(), F.col("car_object"), guid(), F.col("car_action"), F.col("timestamp"), prop("target_guid"), prop("access_level"))
    return out.select(
        identity(key, case).alias("id"), *SCOPE, "car_object", "car_action", "guid", acting.alias("process_entity_id"), iso_z(F.col("ts")).alias("at"), "timestamp", "source_artefact", "link_confidence", "object_refs",
        F.map_filter(F.map_from_entries(F.transform("object_refs", lambda i: F.struct(i, roles(i)))), lambda k, v: F.size(v) > 0).alias("roles"),
        *([F.map_filter("props", lambda k, v: ~F.array_contains("homed", k) & (F.coalesce(v, F.lit("")) != "")).alias("fields")] if "homed" in ready.columns else []), "native",
    )


def ends(ready: DataFrame, observed: DataFrame, case: str) -> DataFrame:
    """(source, source_host, object, guid, ref): what a relation that ends on an event, a process or an account refers to."""
    each = ready.select(*SCOPE, F.struct("timestamp", "row_id").alias("at"), F.explode("things").alias("t")).where("t.end_guid IS NOT NULL AND t.end_object IS NOT NULL")
    keyed = each.select(*SCOPE, F.col("t.end_object").alias("object"), F.col("t.end_guid").alias("guid"), F.col("t.key").alias("key"), F.struct("t.rank", "at").alias("at")).where(~F.col("object").isin(OCCURRENCES))
    first = keyed.groupBy(*SCOPE, "object", "guid").agg(F.min_by("key", "at").alias("key")).withColumn("ref", identity(F.col("key"), case)).drop("key")
    event = observed.where(F.col("car_object").isin(OCCURRENCES)).groupBy(*SCOPE, F.col("car_object").alias("object"), F.col("guid").cast("string").alias("guid")).agg(F.min_by("id", F.struct("timestamp", "id")).alias("ref"))
    return first.unionByName(event)


def relationships(edges: DataFrame, known: DataFrame, case: str) -> DataFrame:
    """Relations with the identities of both ends; ``source_ref`` or ``target_ref`` is null where an end is no object of the case.

    An inferred end is its node. Verbs are in the standard's letters, and an edge without one gives none. Equal relations are one.
    """
    verb = F.regexp_replace(F.regexp_replace(F.lower("relationship"), "[^a-z0-9-]+", "-"), "^-+|-+$", "")
    told = edges.withColumn("verb", verb).where("verb <> ''")
    for end in ("source", "target"):
        index = known.select(*(F.col(c).alias(f"_{c}") for c in (*SCOPE, "object", "guid")), F.col("ref").alias(f"_found_{end}"))
        told = told.join(index, joins.same(told, index, {"source": "_source", "source_host": "_source_host", f"{end}_object": "_object", f"{end}_guid": "_guid"}), "left").drop("_source", "_source_host", "_object", "_guid")
        node = F.when(F.coalesce(F.col("inferred_end") == end, F.lit(False)), identity(scoped("x-inferred-node", host(), F.col(f"{end}_guid")), case))
        told = told.withColumn(f"{end}_ref", F.coalesce(node, F.col(f"_found_{end}")))
    level = F.try_element_at(F.create_map(*(F.lit(x) for pair in CONFIDENCE.items() for x in pair)), "confidence")
    cls = F.coalesce("class", F.lit("declared"))
    key = scoped("relationship", cls, F.col("verb"), F.coalesce("source_ref", F.concat_ws("/", "source_object", "source_guid")), F.coalesce("target_ref", F.concat_ws("/", "target_object", "target_guid")), iso_z(F.col("timestamp")), F.col("method"))
    out = told.select(
        identity(key, case).alias("id"), *SCOPE, F.col("verb").alias("relationship_type"), "source_ref", "target_ref", iso_z(F.col("timestamp")).alias("start_time"), cls.alias("class"), "method", "confidence", level.alias("level"),
        "identity_key", "inferred_end", "corroborated_by", "properties", F.when(F.col("inferred_end") == "source", F.col("source_guid")).when(F.col("inferred_end") == "target", F.col("target_guid")).alias("node_id"),
        F.when(F.col("inferred_end") == "source", F.col("source_object")).otherwise(F.col("target_object")).alias("node_object"),
    )
    # the identity is over both ends, so that they are keys like it, and the rest is made only for those who read it
    keys = ["id", "source_ref", "target_ref"]
    rest = [c for c in out.columns if c not in keys]
    return out.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("source", "source_host", F.col("identity_key"))).alias("r")).select(*keys, "r.*")


def inferred(nodes: DataFrame, related: DataFrame, case: str) -> DataFrame:
    """Inferred nodes as objects that are flagged as such, with those that only a relation names."""
    key = ["source_host", "node_id"]
    own = nodes.groupBy(*key).agg(*(F.min_by(c, "source").alias(c) for c in nodes.columns if c not in key))
    named = related.where("node_id IS NOT NULL").groupBy(*key).agg(F.min_by(F.struct(F.col("node_object").alias("object"), "identity_key", "method", "corroborated_by"), "id").alias("n"))
    alone = named.join(own, joins.same(named, own, {k: k for k in key}), "left_anti").select(*key, "n.*")
    alone = alone.withColumns({"identity_value": F.col("node_id"), "reason": F.lit("referenced by a derived relationship only; no observed record (reconstructed, not evidence)")})
    return own.unionByName(alone, allowMissingColumns=True).withColumn("id", identity(scoped("x-inferred-node", host(), F.col("node_id")), case))


def short(ref: Column) -> Column:
    """An identity as bytes, its kind and the 16 of its UUID; different identities stay different, those of another form too."""
    tail = F.substring(ref, -38, 38)
    plain = tail.rlike("^--[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z") & ~ref.startswith("\x00")
    kind = F.encode(F.substring(ref, F.lit(1), F.length(ref) - 38), "UTF-8")
    return F.when(plain, F.concat(kind, F.unhex(F.replace(tail, F.lit("-"), F.lit(""))))).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(ref, "UTF-8")))


def connected(observed: DataFrame, related: DataFrame) -> DataFrame:
    """(id, source_ref, target_ref, relationships): the pairs of things of an observation that are related, and by how many relations.

    An observation's pairs are made of its own row, a bounded number; no thing's observations meet its relations. The relations
    of a pair are those of ``related`` with both ends. A pair is shuffled once for both directions, as bytes, if any relation is
    between things of its two kinds; the relations have the identities as texts.
    """
    told = related.where("source_ref IS NOT NULL AND target_ref IS NOT NULL").groupBy("source_ref", "target_ref").agg(F.count("*").alias("relationships"))
    told = written(told)
    low, high = F.least("source_ref", "target_ref"), F.greatest("source_ref", "target_ref")
    kind = lambda ref: F.substring_index(ref, "--", 1)
    kinds = told.select(kind(low).alias("low_kind"), kind(high).alias("high_kind")).distinct()
    # both ends as rows, by generated code, and shortened when few are left
    pairs = observed.select("id", "object_refs", F.explode("object_refs").alias("low")).select("id", "low", F.explode("object_refs").alias("high")).where("low < high")
    pairs = pairs.withColumns({"low_kind": kind(F.col("low")), "high_kind": kind(F.col("high"))}).join(F.broadcast(kinds), ["low_kind", "high_kind"], "left_semi")
    pairs = pairs.select("id", short(F.col("low")).alias("low"), short(F.col("high")).alias("high"))
    told = told.withColumns({"low": short(low), "high": short(high)})
    return pairs.join(told, ["low", "high"]).select("id", "source_ref", "target_ref", "relationships")


def sightings(hits: DataFrame, observed: DataFrame, case: str) -> DataFrame:
    """A sighting for each hit of a rule, of (rule_id, clause) on an event, with the observation of the event if there is one."""
    index = observed.groupBy(*SCOPE, "car_object", "guid").agg(F.min_by("id", F.struct("timestamp", "id")).alias("_seen"))
    index = index.select(*(F.col(c).alias(f"_{c}") for c in (*SCOPE, "car_object", "guid")), "_seen")
    found = hits.join(index, joins.same(hits, index, {c: f"_{c}" for c in (*SCOPE, "car_object", "guid")}), "left")
    key = scoped("sighting", F.col("rule_id"), host(), guid(), F.col("timestamp"), F.col("clause"))
    return found.select(
        identity(key, case).alias("id"), identity(scoped("indicator", F.col("rule_id")), "").alias("sighting_of_ref"), "rule_id", "clause", *SCOPE, "car_object", "guid", iso_z(parse_ts(F.col("timestamp"))).alias("at"),
        F.array_compact(F.array("_seen")).alias("observed_data_refs"), F.when(host().isNotNull(), identity(scoped("identity", host()), case)).alias("where_sighted_ref"),
    )


# -- documents --------------------------------------------------------------------------------------------------------------


def nested(values: Mapping[str, Column]) -> Column:
    """A struct of values by their dotted names; parts without any value are null, and so not written."""
    groups: dict[str, dict[str, Column]] = {}
    for name, v in values.items():
        head, _, tail = name.partition(".")
        groups.setdefault(head, {})[tail] = v
    parts = []
    for head, inner in groups.items():
        if "" in inner:
            parts.append(inner[""].alias(head))
        else:
            there = reduce(lambda a, b: a | b, (v.isNotNull() for v in inner.values()))
            parts.append(F.when(there, nested(inner)).alias(head))
    return F.struct(*parts)


@cache
def layout() -> dict[str, list[str]]:
    """The properties that objects of each kind have, by what is declared."""
    out: dict[str, list[str]] = {"file": [f"hashes.{n}" for n in HASHES.values()], "x-record": ["x_object", "x_event_id", "x_source_host"]}
    for own in things().values():
        for t in own:
            for kind in ("ipv4-addr", "ipv6-addr") if t.kind == "ip" else (t.kind,):
                have = out.setdefault(kind, [])
                have += [p for p in t.properties if p not in have and p not in SHOWN_OTHERWISE]
    out["email-addr"] = out["url"] = ["value"]
    return out


def object_documents(made: DataFrame) -> DataFrame:
    """(id, kind, document): objects as JSON texts with typed and nested properties."""
    def typed(name: str) -> Column:
        held = F.try_element_at("fields", F.lit(name))
        if name == "values":
            return F.transform(held, lambda v: F.from_json(v, "name string, data string, data_type string"))
        if name in LISTS:
            return held
        return held[0].try_cast("bigint" if name in NUMBERS else "boolean" if name in BOOLEANS else "string")

    fixed = {"type": F.col("kind"), "spec_version": F.lit(VERSION), "id": F.col("id")}
    conflicts = {"x_conflicts": F.when(F.size("conflicts") > 0, F.col("conflicts"))}
    texts = [F.when(F.col("kind") == kind, F.to_json(nested(fixed | {p: typed(p) for p in names} | conflicts))) for kind, names in layout().items()]
    return made.select("id", "kind", F.coalesce(*texts).alias("document"))


def bundle(rows: DataFrame, edges: DataFrame, nodes: DataFrame, case: str, hits: DataFrame | None = None) -> DataFrame:
    """(id, kind, document): all objects of a case, one row each."""
    files, contents = observables.content_files(rows)
    ready = prepared(rows, contents)
    observed = written(observations(ready, case))
    known = ends(ready, observed, case)
    related = written(relationships(edges, known, case))
    latest = ready.agg(iso_z(F.max("ts"))).first()[0]
    of = lambda kind, df, columns: df.select("id", F.lit(kind).alias("kind"), F.to_json(F.struct(F.lit(kind).alias("type"), F.lit(VERSION).alias("spec_version"), "id", *(v.alias(k) for k, v in columns.items()))).alias("document"))
    pairs = connected(observed, related)
    links = related.where("source_ref IS NOT NULL AND target_ref IS NOT NULL")
    inner = pairs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("source_ref", "target_ref", "relationships"))).alias("connected"))
    col = F.col
    everything = object_documents(objects(ready, case, files))
    everything = everything.unionByName(of("observed-data", observed.join(inner, "id", "left"), {
        "created": col("at"), "modified": col("at"), "first_observed": col("at"), "last_observed": col("at"), "number_observed": F.lit(1), "object_refs": col("object_refs"), "labels": F.array(F.concat(F.lit("car:"), "car_object")),
        "x_object": col("car_object"), "x_action": col("car_action"), "x_event_id": col("guid"), "x_process_entity_id": col("process_entity_id"), "x_source_host": col("source_host"), "x_source_artefact": col("source_artefact"),
        "x_link_confidence": col("link_confidence"), "x_timestamp": col("timestamp"), "x_roles": col("roles"), "x_fields": col("fields"), "x_native": col("native"), "x_connected": col("connected"),
    }))
    created = F.coalesce("start_time", F.lit(latest))
    everything = everything.unionByName(of("relationship", links, {
        "created": created, "modified": created, "relationship_type": col("relationship_type"), "source_ref": col("source_ref"), "target_ref": col("target_ref"), "start_time": col("start_time"), "confidence": col("level"),
        "labels": F.array_compact(F.array(F.concat(F.lit("car:"), "class"), F.concat(F.lit("car:"), "method"))), "x_class": col("class"), "x_method": col("method"), "x_confidence": col("confidence"), "x_identity_key": col("identity_key"),
        "x_inferred_end": col("inferred_end"), "x_corroborated_by": col("corroborated_by"), "x_properties": col("properties"), "x_source_host": col("source_host"),
    }))
    shape = F.create_map(*(F.lit(x) for pair in STANDS_FOR.items() for x in pair))
    first, last = F.coalesce(iso_z(col("first_seen")), F.lit(latest)), F.coalesce(iso_z(col("last_seen")), iso_z(col("first_seen")), F.lit(latest))
    everything = everything.unionByName(of("x-inferred-node", inferred(nodes, related, case), {
        "created": first, "modified": last, "labels": F.array(F.lit("car:inferred"), F.lit("car:reconstructed")), "confidence": F.lit(CONFIDENCE["inferred"]), "x_inferred": F.lit(True), "x_asserted": F.lit(False), "x_would_be": F.try_element_at(shape, "object"),
        "x_object": col("object"), "x_node_id": col("node_id"), "x_source_host": col("source_host"), "x_identity_key": col("identity_key"), "x_identity_value": col("identity_value"), "x_method": col("method"), "x_reason": col("reason"),
        "x_corroborated_by": col("corroborated_by"), "x_properties": col("properties"),
    }))
    if hits is not None:
        everything = everything.unionByName(of("sighting", sightings(hits, observed, case), {
            "created": F.coalesce("at", F.lit(latest)), "modified": F.coalesce("at", F.lit(latest)), "sighting_of_ref": col("sighting_of_ref"), "count": F.lit(1), "first_seen": col("at"), "last_seen": col("at"),
            "observed_data_refs": F.when(F.size("observed_data_refs") > 0, col("observed_data_refs")), "where_sighted_refs": F.array_compact(F.array("where_sighted_ref")), "x_rule": col("rule_id"), "x_clause": col("clause"), "x_event_id": col("guid"),
        }))
    return everything


def export(rows: DataFrame, edges: DataFrame, nodes: DataFrame, case: str, out: str, hits: DataFrame | None = None) -> None:
    """The objects of a case as JSON lines under ``out``, a folder for each kind."""
    bundle(rows, edges, nodes, case, hits).select("kind", "document").write.mode("overwrite").partitionBy("kind").text(out)
