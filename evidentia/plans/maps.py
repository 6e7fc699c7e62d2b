"""Maps of tool records to events: declarations only; the engine is ``apply``.

A map lists its variants in order: the first whose gate holds makes the row. Names of keys, fields, actions and event
numbers are fixed values of the tools and of the event model.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import identities, ids, markers, times
from evidentia.functions.blanks import nb, truthy, two_valued
from evidentia.plans.model import FIELDS, HEADER
from evidentia.sources import adapters

Value = Callable[["Record"], Column]
#: Fixed value: a program by the device that it lies on.
DEVICE_PATH = r"(?i)^(\\Device\\.+)$"


class Record:
    """Access to one raw record (a VARIANT column): plain keys, keys of an inner record, event payloads, and typed values.

    ``read`` has what was asked for, by column, so that each value is read from the record once; ``moments`` the times of
    events, which identities have too.
    """

    def __init__(self, column: str = "record"):
        self.column = column
        self.read: dict[str, Column] = {}
        self.names: dict[tuple[str, str], str] = {}
        self.moments: dict[Value, Column] = {}

    def value(self, path: str, kind: str) -> Column:
        name = self.names.setdefault((path, kind), f"record_value_{len(self.names)}")
        self.read[name] = F.try_variant_get(self.column, path, kind)
        return F.col(name)

    def __call__(self, key: str) -> Column:
        return self.typed(key, "string")

    def typed(self, key: str, kind: str) -> Column:
        return self.value(f'$["{key}"]', kind)

    def moment(self, timestamp: Value) -> Column:
        self.moments.setdefault(timestamp, times.clean_ts(nb(timestamp(self))))
        return F.col(f"record_moment_{list(self.moments).index(timestamp)}")

    def inner(self, key: str) -> Column:
        return F.try_element_at(F.col("record_inner"), F.lit(key))

    def inner_number(self, key: str) -> Column:
        return self.value(f'$["Record"]["{key}"]', "bigint")

    def inners(self) -> Column:
        """The inner record's values by key, trimmed; blank ones left out."""
        return markers.tidy(F.try_variant_get(self.column, '$["Record"]', "map<string,string>"))

    def paths(self) -> dict[str, Column]:
        """Values of an inner record that several fields of an event are made of, by column, so that each is made once.

        Paths: the file name, else the display name without the type before its colon; the entry's name; a shell item's;
        a link's target. Homes: the account in whose home a path lies. A started program's name, the visited address and
        the program of a resource usage row.
        """
        one = lambda key, pattern: markers.regex1(self.inner(key), pattern)
        display, after_prefix, home = self.inner("display_name"), r"^(?:<[^>]+>\s*)?(.+)$", r"(?i)[/\\]Users[/\\]([^/\\]+)[/\\]"
        first = lambda *values: F.coalesce(*values)  # noqa: E731  (none of these is blank)
        return {
            "record_shown": markers.first(self.inner("filename"), markers.regex1(display, r"\A[A-Z0-9]+:(.*)\z"), display),
            "record_entry": markers.first(self.inner("name"), self.inner("filename")),
            "record_typed": first(one("display_name", r"^[^:]+:(.+)$"), display),
            "record_shell": markers.unescape_backslashes(first(one("shell_item_path", after_prefix), self.inner("long_name"), self.inner("name"))),
            "record_link": markers.unescape_backslashes(first(self.inner("local_path"), self.inner("network_path"), one("link_target", after_prefix))),
            "record_home": one("display_name", home),
            "record_shell_home": one("shell_item_path", home),
            "record_link_home": first(one("local_path", home), one("network_path", home), one("link_target", home)),
            "record_deleted_home": one("original_filename", home),
            "record_run": first(one("value_name", r"^UEME_RUNPATH:(.+)$"), one("value_name", r"^(?!UEME_)(.+)$")),
            "record_visited": first(one("url", r"^Visited:\s*[^@]*@(.+)$"), self.inner("url")),
            "record_cached": first(one("url", r"^HTTP:(.+)$"), self.inner("url")),
            "record_device": one("application", DEVICE_PATH),
            "record_host": self.inner("image_hostname"),
            "record_user": self.inner("username"),
        }

    def payload(self, name: str) -> Column:
        return F.try_element_at(F.col(markers.CLEANED["values"]), F.lit(name))

    def userdata(self, name: str) -> Column:
        return F.try_element_at(F.col(markers.CLEANED["children"]), F.lit(name))


def of(key: str) -> Value:
    return lambda r: r(key)


def data(name: str) -> Value:
    return lambda r: r.payload(name)


def child(name: str) -> Value:
    return lambda r: r.userdata(name)


def inner(name: str) -> Value:
    return lambda r: r.inner(name)


def const(value: str) -> Value:
    return lambda r: F.lit(value)


@dataclass(frozen=True)
class Variant:
    gate: Value
    kind: str
    action: Value
    guid: Value | str  # or the name of an entry of minted identities
    timestamp: Value
    props: Mapping[str, Value]
    host: Value = const("")
    native: Mapping[str, Value] = field(default_factory=dict)
    keep: tuple[str, ...] = ()
    owning_pid: Value | None = None
    owning_guid: Value | None = None
    parent_pid: Value | None = None

    def component(self, r: Record, source: str) -> Column:
        """What an identity reads: a column of the event, or a key of its native bag."""
        if source == "timestamp":
            return r.moment(self.timestamp)
        if source == "owning_pid":
            return self.owning_pid(r)
        return self.native[source.removeprefix("native.")](r) if source.startswith("native.") else self.props[source](r)

    def holds(self, r: Record) -> Column:
        return two_valued(self.gate(r)) & self.action(r).isNotNull()

    def columns(self, r: Record, artefact: str) -> dict[str, Column]:
        """The event's columns, for a record for which the variant holds."""
        bag = [x for k in self.keep for x in (F.lit(k), r(k))] + [x for k, v in self.native.items() for x in (F.lit(k), v(r).cast("string"))]
        minted = isinstance(self.guid, str)
        if minted:
            bag += [x for k, v in identities.stamps(self.guid, lambda source: self.component(r, source), r).items() for x in (F.lit(k), v)]
        told = [x for k, v in self.props.items() for x in (F.lit(k), v(r).cast("string"))]
        known = lambda pairs, test: F.map_filter(F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>"), test)
        optional = lambda v: (v(r) if v else F.lit(None)).cast("string")
        return {
            "car_object": F.lit(self.kind), "car_action": self.action(r), "guid": F.lit(None).cast("string") if minted else nb(self.guid(r)), "timestamp": r.moment(self.timestamp),
            "source_host": F.nullif(self.host(r), F.lit("")), "source_artefact": F.lit(artefact), "owning_pid": optional(self.owning_pid),
            "owning_guid_native": optional(self.owning_guid), "parent_pid": optional(self.parent_pid), "props": known(told, lambda k, v: ~v.isin("", "-")), "native": known(bag, lambda k, v: v.isNotNull()),
        }


def apply(records: DataFrame, maps: Mapping[str, list[Variant]], default_host: str | None = None, record: str = "record") -> DataFrame:
    """Events of all maps in one scan: of each map the first variant whose gate holds. Other columns come along."""
    r = Record(record)
    variants = [(name, v) for name, own in maps.items() for v in own]
    chosen = F.array(*(F.coalesce(*(F.when(v.holds(r), i) for i, (name, v) in enumerate(variants) if name == m)) for m in maps))
    # columns of their own, not structs of an array: what nobody reads is not made
    each = [v.columns(r, name) for name, v in variants]
    of = lambda c: reduce(lambda made, i: made.when(F.col("_variant") == i, each[i][c]), range(len(each)), F)
    others = [c for c in records.columns if c != record]
    payload, inners, paths = r("Payload"), r.inners(), r.paths()
    # values, payloads and inner records are read once, in projections of their own, and not at all where no map reads them
    wide = records.withColumns(r.read | {"record_inner": inners}).withColumns(markers.parsed(payload))
    wide = wide.withColumns(markers.cleaned({c: F.col(c) for c in markers.PARSED.values()}) | paths)
    wide = wide.withColumns({f"record_moment_{i}": made for i, made in enumerate(r.moments.values())})
    out = wide.select("*", F.explode(chosen).alias("_variant")).where("_variant IS NOT NULL").select(*others, *(of(c).alias(c) for c in each[0]))
    if any(isinstance(v.guid, str) for _, v in variants):
        # a column of its own: the parts of an identity share its hash
        out = out.withColumn("_hash", identities.hash_of(F.try_element_at("native", F.lit(identities.KEY))))
        out = out.withColumn("guid", F.coalesce("guid", identities.uuid_of_sha1(F.col("_hash")))).drop("_hash")
    return out.withColumn("source_host", F.coalesce("source_host", F.lit(default_host).cast("string")))


def widened(events: DataFrame, kind: str) -> DataFrame:
    """Events of one object with a column for each of its fields."""
    own = [f for f in FIELDS[kind] if f not in HEADER]
    return events.where(F.col("car_object") == kind).select("*", *(F.try_element_at("props", F.lit(f)).alias(f) for f in own)).drop("props")


def event_id(r: Record) -> Column:
    return r("EventId").try_cast("int")


def event(channel: str, *numbers: int) -> Value:
    """Gate of event numbers, as numbers, in channels whose name contains a word."""
    return lambda r: r.typed("EventId", "int").isin(*numbers) & F.contains(r("Channel"), F.lit(channel))


def sysmon(number: int, *kinds: str) -> Value:
    """Gate of a monitor event, by its provider; of some event types where they are given."""
    own = lambda r: F.contains(F.lower(r("Provider")), F.lit("sysmon")) & (event_id(r) == number)
    return (lambda r: own(r) & r.payload("EventType").isin(*kinds)) if kinds else own


def record_guid(kind: str, *keys: str) -> Value:
    return lambda r: ids.fields_guid(kind, *(r(k) for k in keys))


def windows_guid(kind: str) -> Value:
    return record_guid(kind, "Computer", "Channel", "EventRecordId")


def computer(r: Record) -> Column:
    return markers.host_label(r("Computer"))


def user(name: str) -> Value:
    return lambda r: markers.user_canon(r.payload(name))


def file_hash(algorithm: str) -> Value:
    return lambda r: markers.lower(markers.regex1(r.payload("Hashes"), rf"(?i)\b{algorithm}=([0-9A-Fa-f]+)"))


HASHES = {"md5_hash": file_hash("MD5"), "sha1_hash": file_hash("SHA1"), "sha256_hash": file_hash("SHA256")}
WINDOWS_KEEP = ("EventId", "EventRecordId", "Channel", "Computer", "Payload", "SourceFile", "MapDescription")
WINDOWS = {"timestamp": of("TimeCreated"), "host": computer, "keep": WINDOWS_KEEP}
NAMES = {"hostname": computer, "fqdn": lambda r: markers.regex1(r("Computer"), r"^([^.]+\..+)$")}
LOGON_TYPES = {"2": "interactive", "3": "network", "4": "batch", "5": "service", "7": "unlock", "8": "network_cleartext", "9": "new_credentials", "10": "remote_interactive", "11": "cached_interactive"}

AUTHENTICATION = {
    "target_user": data("TargetUserName"), "target_uid": data("TargetUserSid"), "target_ad_domain": data("TargetDomainName"), "user": user("SubjectUserName"), "uid": data("SubjectUserSid"),
    "ad_domain": data("SubjectDomainName"), "hostname": data("WorkstationName"), "auth_target": of("Computer"), "method": data("AuthenticationPackageName"), "auth_service": data("LogonProcessName"),
    "app_name": lambda r: markers.basename(r.payload("ProcessName")),
}
AUTHENTICATION_NATIVE = {k: data(k) for k in ("TargetLogonId", "SubjectLogonId", "LogonType", "IpAddress")}
SESSION = {
    "user": lambda r: markers.user_canon(markers.first(r.payload("TargetUserName"), r.payload("AccountName"), r("UserName"))), "uid": data("TargetUserSid"),
    "login_id": lambda r: markers.first(r.payload("TargetLogonId"), r.payload("LogonID")), "login_type": lambda r: markers.map_value(r.payload("LogonType"), LOGON_TYPES), "hostname": computer,
    "src_ip": lambda r: markers.regex1(markers.first(r.payload("IpAddress"), r.payload("ClientAddress")), r"^(?!(?:::1|127\.0\.0\.1|LOCAL)\z)(.+)\z"),
    "src_port": lambda r: markers.regex1(r.payload("IpPort"), r"^(?!0\z)(\d+)\z"),
}
SESSION_NATIVE = {k: data(k) for k in ("LogonType", "SubjectLogonId", "WorkstationName", "ClientName", "SessionName")}


def service_command(r: Record) -> Column:
    return markers.first(r.payload("ImagePath"), r.payload("ServiceFileName"))


SERVICE = {
    "name": data("ServiceName"), "image_path": lambda r: markers.exe_path(service_command(r)), "exe": lambda r: markers.basename(markers.exe_path(service_command(r))), "command_line": service_command,
    "user": lambda r: markers.user_canon(markers.first(r.payload("AccountName"), r.payload("ServiceAccount"), r("UserName"))), **NAMES,
}

PROCESS = {"exe": data("Image"), "image_path": data("Image"), "pid": data("ProcessId"), "user": user("User"), **NAMES}
ACTOR = {"image_path": data("Image"), "pid": data("ProcessId"), "user": user("User"), **NAMES}
OWNED = {"owning_pid": data("ProcessId"), "owning_guid": data("ProcessGuid")}
TARGET_FILE = {"file_path": data("TargetFilename"), "file_name": lambda r: markers.basename(r.payload("TargetFilename")), "extension": lambda r: markers.ext(r.payload("TargetFilename"))}


def monitored(gate: Value, kind: str, action: str, props: Mapping[str, Value], native: tuple[str, ...] = (), guid: Value | None = None, **more) -> Variant:
    """A monitor event; who did it owns it."""
    return Variant(gate, kind, const(action), guid or windows_guid(kind), props=props, native={k: data(k) for k in ("UtcTime", *native)}, **(WINDOWS | OWNED | more))


FIVE = {"src_ip": of("id.orig_h"), "src_port": of("id.orig_p"), "dest_ip": of("id.resp_h"), "dest_port": of("id.resp_p")}
EPOCH = lambda r: times.epoch_ts(r("ts"), r("ts"))
HTTP = {
    "url_domain": lambda r: markers.lower(F.split_part(r("host"), F.lit("/"), F.lit(1))), "url_remainder": of("uri"), "http_version": of("version"), "requester_ip_address": of("id.orig_h"),
    "request_body_bytes": of("request_body_len"), "response_body_bytes": of("response_body_len"), "response_status_code": of("status_code"), "request_referrer": of("referrer"), "user_agent_full": of("user_agent"),
}
HTTP_KEEP = ("uid", "id.orig_p", "id.resp_h", "id.resp_p", "method", "status_msg", "trans_depth", "resp_fuids", "orig_fuids", "origin", "username")
CONNECTION_STATES = {"SF": "end", "REJ": "end", "RSTO": "end", "RSTR": "end", "S0": "start"}


def packets(r: Record) -> Column:
    count = lambda k: r(k).try_cast("double").try_cast("bigint")
    both = F.coalesce(count("orig_pkts"), F.lit(0)) + F.coalesce(count("resp_pkts"), F.lit(0))
    return F.when(count("orig_pkts").isNotNull() | count("resp_pkts").isNotNull(), both)


def connection_end(r: Record) -> Column:
    start = F.timestamp_micros(F.rint(r("ts").try_cast("double") * 1000000).cast("bigint"))
    return times.iso(times.duration_end(start, r("duration").try_cast("double")))


def registry_data(r: Record) -> Column:
    return markers.first(r("ValueData"), r("ValueData2"), r("ValueData3"))


CHANNEL_KEEP = (*WINDOWS_KEEP, "Provider", "UserName")
CHANNEL = WINDOWS | {"keep": CHANNEL_KEEP}
HOSTNAME = {"hostname": computer}


def url_part(pattern: str) -> Value:
    return lambda r: markers.regex1(r.payload("url"), pattern)


def name_of(value: Value) -> Value:
    return lambda r: markers.basename(value(r))


#: Descriptions of timestamps that tell what was done to a file, tried in this order.
STAMPS = {"create": r"(?i)creation|crtime|birth", "modify": r"(?i)modification|mtime", "read": r"(?i)last access|atime", "delete": r"(?i)deletion|deleted"}
PROVENANCE = ("disk_id", "volume_id", "volume_offset")


def stamped(pattern: str) -> Value:
    return lambda r: F.translate(r.inner("timestamp_desc"), "İı", "ii").rlike(pattern)


def made(name: str) -> Value:
    """A value of an inner record that was made beforehand."""
    return lambda r: F.col(f"record_{name}")


def made_first(*names: str) -> Value:
    return lambda r: F.coalesce(*(F.col(f"record_{n}") for n in names))


INNER = {"timestamp": of("Timestamp"), "host": lambda r: markers.host_label(r.inner("image_hostname")), "keep": ("SourceImage", "Parser")}


def file_row(gate: Value, action: str, guid: str, path: Value, native: tuple[str, ...], whole: bool = False) -> Variant:
    """A file at a time: hashes and owner where the parser has them; a time of creation only where it is one."""
    props = {"file_path": path, "extension": lambda r: markers.ext(path(r)), "file_name": name_of(path), "hostname": inner("image_hostname"), "user": inner("username")}
    if whole:
        props |= {f"{h}_hash": (lambda r, h=h: markers.lower(r.inner(f"{h}_hash"))) for h in ("md5", "sha1", "sha256")} | {"mode": inner("mode"), "owner_uid": inner("owner_identifier"), "gid": inner("group_identifier")}
    if action == "create":
        props |= {"creation_time": of("Timestamp")}
    return Variant(gate, "file", const(action), guid, props=props, native={k: inner(k) for k in (*native, *PROVENANCE)}, **INNER)


def session_row(gate: Value, action: str, guid: str, native: tuple[str, ...], **more: Value) -> Variant:
    remote = lambda r: markers.regex1(r.inner("ip_address"), r"\A(?!(?:0\.0\.0\.0|127\.0\.0\.1|::1)\z)(.+)\z")
    return Variant(gate, "user_session", const(action), guid, props={"user": inner("username"), "hostname": inner("image_hostname"), "src_ip": remote, **more}, native={k: inner(k) for k in native}, owning_pid=inner("pid"), **INNER)


def reason_bit(bit: int) -> Value:
    return lambda r: F.coalesce(r.inner_number("update_reason_flags"), F.lit(0)).bitwiseAND(bit) != 0


def login_kind(*numbers: int) -> Value:
    return lambda r: r.inner_number("login_type").isin(*numbers)


STAT_NATIVE = ("timestamp_desc", "data_type", "file_entry_type", "file_size", "file_system_type", "is_allocated", "inode", "number_of_links", "display_name")
ENTRY_NATIVE = ("timestamp_desc", "data_type", "path_hints", "file_reference", "parent_file_reference", "is_allocated", "file_attribute_flags", "display_name")
JOURNAL_NATIVE = ("timestamp_desc", "data_type", "update_reason_flags", "update_source_flags", "update_sequence_number", "file_reference", "parent_file_reference", "file_attribute_flags", "display_name", "offset")
LOGIN_NATIVE = ("data_type", "login_type", "hostname", "terminal", "terminal_identifier", "exit_status")



def typed_as(*kinds: str) -> Value:
    return lambda r: r.inner("data_type").isin(*kinds)


def both(*gates: Value) -> Value:
    def test(r: Record) -> Column:
        out = two_valued(gates[0](r))
        for g in gates[1:]:
            out = out & two_valued(g(r))
        return out

    return test


def unless(gate: Value) -> Value:
    return lambda r: ~two_valued(gate(r))


def parsed_by(pattern: str) -> Value:
    """Gate of the parser's name, in lower case."""
    return lambda r: F.lower(r("Parser")).rlike(pattern)


def part_of(value: Value, pattern: str) -> Value:
    return lambda r: markers.regex1(value(r), pattern)


def either(*values: Value) -> Value:
    return lambda r: markers.first(*(v(r) for v in values))


def lowered(value: Value) -> Value:
    return lambda r: markers.lower(value(r))


def account(value: Value) -> Value:
    return lambda r: markers.user_canon(value(r))


def file_at(path: Value) -> dict[str, Value]:
    return {"file_path": path, "file_name": name_of(path), "extension": lambda r: markers.ext(path(r))}


def program(path: Value) -> dict[str, Value]:
    return {"exe": lambda r: markers.win_program_name(path(r)), "image_path": lambda r: markers.win_program_path(path(r)), "user": account(made("user"))}


def visited(address: Value) -> dict[str, Value]:
    return {"url_full": address, "url_scheme": part_of(address, r"^(https?)://"), "url_domain": part_of(address, r"^https?://([^/?#:]+)"), "url_remainder": part_of(address, r"^https?://[^/]+(/[^\s]*)")}


def inners(*names: str, **renamed: str) -> dict[str, Value]:
    return {k: inner(k) for k in names} | {k: inner(v) for k, v in renamed.items()}


def image_host(r: Record) -> Column:
    return F.col("record_host")


def image_label(r: Record) -> Column:
    return markers.host_label(image_host(r))


def nothing(r: Record) -> Column:
    """No time: what is told holds of the thing, not of a moment."""
    return F.lit(None).cast("string")


def disk_row(gate: Value, kind: str, action: str | Value, identity: str, props: Mapping[str, Value], native: Mapping[str, Value], host: Value = image_label, timestamp: Value = of("Timestamp"), keep: tuple[str, ...] = (), name: Value | None = image_host) -> Variant:
    """An event of a disk image's timeline."""
    named = {"hostname": name} if name else {}
    return Variant(gate, kind, const(action) if isinstance(action, str) else action, identity, timestamp, props={**props, **named}, host=host, native=native, keep=keep)


def execution(gate: Value, kind: str, identity: str, props: Mapping[str, Value], *names: str, native: Mapping[str, Value] | None = None, **more) -> Variant:
    """A trace of a program, with where it was found."""
    found = inners("data_type", "timestamp_desc", *names, artefact_file="display_name", artefact_sha256="sha256_hash")
    return disk_row(gate, kind, "create", identity, props, found | (native or {}), **({"host": image_host, "keep": ("SourceImage", "Parser")} | more))


CREATED, MODIFIED, READ = stamped(r"(?i)creation|crtime|birth"), stamped(r"(?i)modification|mtime"), stamped(r"(?i)last access|atime|access time")
MOMENTS = {"create": CREATED, "modify": MODIFIED, "read": READ}
WRITTEN = stamped(r"(?i)modification|mtime|last written|content")
COMPILED = stamped(r"(?i)link|compil")
AMCACHE, LINKED_FILE, SHELL_ITEM, DOCUMENT, BINARY = parsed_by("amcache"), typed_as("windows:lnk:link"), typed_as("windows:shell_item:file_entry"), typed_as("olecf:summary_info"), typed_as("pe_coff:file")
FILE_SHA1 = lowered(part_of(inner("file_identifier"), r"(?i)^0000([0-9a-f]{40})$"))
CRON_HOST = either(image_host, inner("hostname"))
#: What the times of a compatibility cache mean.
CACHE_TIMES = {"File Last Modification Time": "file mtime, not run time", "Registry Last Written Time": "registry key write time, not run time", "Last Time Executed": "XP-era cache last-update time (plaso labels it last run)"}
CACHE_OTHER = "cache entry timestamp (see timestamp_desc), not run time"
REGISTRY_NATIVE = (
    "data_type", "values", "name", "object_name", "start_type", "service_type", "service_dll", "error_control", "command", "application", "handler", "trigger", "entries", "username", "fullname", "comments", "account_rid", "login_count", "serial", "vendor", "product", "subkey_name",
    "device_display_name", "device_type", "revision", "server_name", "share_name", "source_type", "drive_letter", "product_name", "build_number", "service_pack", "version", "owner", "configuration", "settings",
)
LINK_NATIVE = (
    "data_type", "description", "working_directory", "relative_path", "file_size", "command_line_arguments", "env_var_location", "icon_location", "file_attribute_flags", "drive_type", "drive_serial_number", "volume_label", "droid_file_identifier", "droid_volume_identifier",
    "birth_droid_file_identifier", "birth_droid_volume_identifier",
)
DOCUMENT_NATIVE = ("data_type", "timestamp_desc", "title", "author", "last_saved_by", "application", "revision_number", "subject", "keywords", "comments", "template", "number_of_pages", "number_of_words", "number_of_characters", "codepage", *PROVENANCE)
USAGE_NATIVE = ("data_type", "identifier", "interface_luid", "user_identifier", "application")
USAGE_KEEP = ("Table", "TableAlias", "AppId", "UserId", "AppIdName", "UserIdName", "TimeStamp")


def used_by(application: Value, image: Value, account_id: Value, column: str) -> dict[str, Value]:
    """The program and the account of a resource usage row."""
    return {"exe": either(name_of(image), application), "image_path": image, column: part_of(account_id, r"^(S-1-[0-9-]+)$")}


def binary(gate: Value, stamp: str | None) -> Variant:
    """A program file without a time of its own; a stamp in it is told beside it."""
    told = inners("data_type", "timestamp_desc", "pe_type", "export_dll_name", "section_names", *PROVENANCE) | {"imphash": lowered(inner("imphash"))} | ({stamp: of("Timestamp")} if stamp else {})
    return disk_row(both(BINARY, gate), "file", "create", "plaso_pecoff", file_at(made("typed")) | {"sha256_hash": lowered(inner("sha256_hash"))}, told, timestamp=nothing)


#: Channels, event numbers, keys and actions of each map.
MAPS: dict[str, list[Variant]] = {
    "evtx_security": [
        Variant(event("Security", 4624), "authentication", const("success"), windows_guid("authentication"), props=AUTHENTICATION, native=AUTHENTICATION_NATIVE, owning_pid=data("ProcessId"), **WINDOWS),
        Variant(event("Security", 4625), "authentication", const("failure"), windows_guid("authentication"), props=AUTHENTICATION | {"decision_reason": lambda r: markers.first(r.payload("SubStatus"), r.payload("Status"), r.payload("FailureReason"))}, native=AUTHENTICATION_NATIVE, owning_pid=data("ProcessId"), **WINDOWS),
        Variant(event("Security", 4672), "authentication", const("success"), windows_guid("authentication"), props={"user": user("SubjectUserName"), "uid": data("SubjectUserSid"), "ad_domain": data("SubjectDomainName"), "auth_target": of("Computer"), "user_role": const("administrator")}, native={k: data(k) for k in ("SubjectLogonId", "PrivilegeList")}, **WINDOWS),
    ],
    "evtx_security_sessions": [
        Variant(event("Security", 4624), "user_session", lambda r: F.coalesce(markers.map_value(r.payload("LogonType"), {"7": "unlock"}), F.lit("login")), windows_guid("user_session"), props=SESSION | {"login_successful": const("true")}, native=SESSION_NATIVE, owning_pid=data("ProcessId"), **WINDOWS),
        Variant(event("Security", 4634, 4647, 4779), "user_session", const("logout"), windows_guid("user_session"), props=SESSION, native=SESSION_NATIVE, **WINDOWS),
        Variant(event("Security", 4778), "user_session", const("reconnect"), windows_guid("user_session"), props=SESSION, native=SESSION_NATIVE, **WINDOWS),
    ],
    "evtx_services": [
        Variant(gate, "service", const("create"), windows_guid("service"), props=SERVICE, native={"StartType": lambda r: markers.first(r.payload("StartType"), r.payload("ServiceStartType")), "ServiceType": data("ServiceType"), "SubjectLogonId": data("SubjectLogonId")}, **WINDOWS)
        for gate in (event("System", 7045), event("Security", 4697))
    ],
    "evtx_process": [
        Variant(event("Security", 4688), "process", const("create"), windows_guid("process"), props={"exe": data("NewProcessName"), "image_path": data("NewProcessName"), "parent_exe": data("ParentProcessName"), "parent_image_path": data("ParentProcessName"), "command_line": data("CommandLine"), "pid": lambda r: markers.hex_int(r.payload("NewProcessId")), "ppid": lambda r: markers.hex_int(r.payload("ProcessId")), "user": user("SubjectUserName"), "sid": data("SubjectUserSid"), **NAMES}, native={"SubjectLogonId": data("SubjectLogonId")}, owning_pid=data("NewProcessId"), parent_pid=data("ProcessId"), **WINDOWS),
    ],
    "evtx_sysmon": [
        monitored(sysmon(1), "process", "create", PROCESS | HASHES | {"parent_exe": data("ParentImage"), "parent_image_path": data("ParentImage"), "command_line": data("CommandLine"), "parent_command_line": data("ParentCommandLine"), "current_working_directory": data("CurrentDirectory"), "integrity_level": data("IntegrityLevel"), "ppid": data("ParentProcessId")}, ("ParentProcessGuid", "LogonId", "LogonGuid", "OriginalFileName", "Company", "Product", "Description", "FileVersion", "ParentUser"), data("ProcessGuid"), parent_pid=data("ParentProcessId")),
        monitored(sysmon(5), "process", "terminate", PROCESS, (), data("ProcessGuid")),
        monitored(sysmon(3), "flow", "start", PROCESS | {"src_ip": data("SourceIp"), "src_port": data("SourcePort"), "src_hostname": data("SourceHostname"), "dest_ip": data("DestinationIp"), "dest_port": data("DestinationPort"), "dest_hostname": data("DestinationHostname"), "transport_protocol": data("Protocol"), "network_direction": lambda r: markers.map_value(r.payload("Initiated"), {"FALSE": "inbound", "TRUE": "outbound"}, upper=True), "start_time": of("TimeCreated")}),
        monitored(sysmon(11), "file", "create", ACTOR | TARGET_FILE | {"creation_time": lambda r: markers.replace(r.payload("CreationUtcTime"), " ", "T")}, ("CreationUtcTime",)),
        monitored(sysmon(23), "file", "delete", ACTOR | TARGET_FILE | HASHES),
        monitored(sysmon(12, "CreateKey", "CreateValue"), "registry", "add", ACTOR | {"key": data("TargetObject")}, ("EventType",)),
        monitored(sysmon(12, "DeleteKey", "DeleteValue"), "registry", "remove", ACTOR | {"key": data("TargetObject")}, ("EventType",)),
        monitored(sysmon(13), "registry", "value_edit", ACTOR | {"key": data("TargetObject"), "value": lambda r: markers.basename(r.payload("TargetObject")), "data": data("Details"), "new_content": data("Details")}, ("EventType",)),
        monitored(sysmon(14), "registry", "key_edit", ACTOR | {"key": data("TargetObject")}, ("EventType", "NewName")),
        monitored(sysmon(7), "module", "load", {k: v for k, v in ACTOR.items() if k != "user"} | HASHES | {"module_path": data("ImageLoaded"), "module_name": lambda r: markers.basename(r.payload("ImageLoaded")), "signer": data("Signature"), "signature_valid": lambda r: markers.map_value(r.payload("SignatureStatus"), {"Valid": "true"})}, ("Signed", "OriginalFileName", "Company", "Product", "Description", "FileVersion")),
        monitored(sysmon(10), "process", "access", {"exe": data("SourceImage"), "image_path": data("SourceImage"), "pid": data("SourceProcessId"), "target_pid": data("TargetProcessId"), "target_guid": data("TargetProcessGUID"), "target_name": data("TargetImage"), "access_level": data("GrantedAccess"), "call_trace": data("CallTrace"), **NAMES}, (), None, owning_pid=data("SourceProcessId"), owning_guid=data("SourceProcessGUID")),
        monitored(sysmon(6), "driver", "load", {"image_path": data("ImageLoaded"), "module_name": lambda r: markers.basename(r.payload("ImageLoaded")), "signer": data("Signature"), "signature_valid": lambda r: markers.map_value(r.payload("SignatureStatus"), {"Valid": "true"}), **HASHES, **NAMES}, ("Signed",), None, owning_pid=None, owning_guid=None),
        monitored(sysmon(8), "thread", "remote_create", {"src_pid": data("SourceProcessId"), "tgt_pid": data("TargetProcessId"), "tgt_tid": data("NewThreadId"), "start_address": data("StartAddress"), "start_module": data("StartModule"), "start_module_name": lambda r: markers.basename(r.payload("StartModule")), "start_function": data("StartFunction"), "hostname": computer}, ("TargetProcessGuid", "SourceImage", "TargetImage"), None, owning_pid=data("SourceProcessId"), owning_guid=data("SourceProcessGuid")),
    ],
    "zeek_conn": [Variant(lambda r: truthy(r("conn_state")), "flow", lambda r: F.coalesce(markers.map_value(r("conn_state"), CONNECTION_STATES), F.lit("message")), of("uid"), EPOCH, FIVE | {"transport_protocol": of("proto"), "application_protocol": of("service"), "tcp_flags": of("history"), "out_bytes": of("orig_bytes"), "in_bytes": of("resp_bytes"), "start_time": EPOCH, "end_time": connection_end, "packet_count": packets}, keep=("uid", "service", "conn_state", "missed_bytes"))],
    "zeek_dns": [Variant(lambda r: truthy(r("query")), "flow", const("message"), record_guid("flow", "uid", "trans_id"), EPOCH, FIVE | {"transport_protocol": of("proto"), "application_protocol": const("dns"), "fqdn": of("query"), "start_time": EPOCH}, keep=("uid", "query", "qtype_name", "rcode_name", "answers", "trans_id"))],
    "zeek_ssl": [Variant(lambda r: truthy(r("uid")) & (truthy(r("version")) | truthy(r("server_name")) | truthy(r("cipher"))), "flow", const("message"), of("uid"), EPOCH, FIVE | {"transport_protocol": lambda r: markers.first(r("proto"), F.lit("tcp")), "application_protocol": const("tls"), "dest_fqdn": of("server_name"), "start_time": EPOCH}, keep=("uid", "server_name", "version", "cipher", "curve", "next_protocol", "resumed", "established", "ssl_history", "cert_chain_fps", "client_cert_chain_fps", "sni_matches_cert", "ja3", "ja3s", "validation_status"))],
    "zeek_x509": [Variant(lambda r: truthy(r("fingerprint")), "file", const("create"), of("fingerprint"), EPOCH, {"sha256_hash": lambda r: markers.lower(r("fingerprint"))}, keep=("fingerprint", "certificate.subject", "certificate.issuer", "certificate.serial", "certificate.version", "certificate.not_valid_before", "certificate.not_valid_after", "san.dns", "host_cert", "client_cert"))],
    "zeek_http": [
        Variant(lambda r: F.upper(r("method")).isin("GET", "POST", "PUT"), "http", lambda r: markers.map_value(r("method"), {"GET": "get", "POST": "post", "PUT": "put"}, upper=True), record_guid("http", "uid", "trans_depth"), EPOCH, HTTP | {"url_scheme": const("http"), "url_full": lambda r: markers.concat(F.lit("http://"), r("host"), r("uri"))}, keep=HTTP_KEEP),
        Variant(lambda r: F.upper(r("method")) == "CONNECT", "http", const("tunnel"), record_guid("http", "uid", "trans_depth"), EPOCH, HTTP, keep=HTTP_KEEP),
    ],
    "zeek_smtp": [Variant(lambda r: truthy(r("mailfrom")) | truthy(r("from")) | truthy(r("subject")), "email", const("deliver"), record_guid("email", "uid", "trans_depth"), EPOCH, FIVE | {"src_address": lambda r: markers.first(r("mailfrom"), r("from")), "dest_address": lambda r: markers.first(r("rcptto"), r("to")), "src_domain": lambda r: markers.domain_of(markers.first(r("mailfrom"), r("from"))), "from": of("from"), "to": of("to"), "subject": of("subject"), "date": of("date")}, keep=("uid", "trans_depth", "helo", "path", "tls", "fuids", "last_reply"))],
    "zeek_files": [Variant(lambda r: truthy(r("fuid")), "file", const("create"), record_guid("file", "fuid"), EPOCH, {"file_name": of("filename"), "extension": lambda r: markers.ext(r("filename")), "mime_type": of("mime_type"), "md5_hash": lambda r: markers.lower(r("md5")), "sha1_hash": lambda r: markers.lower(r("sha1")), "sha256_hash": lambda r: markers.lower(r("sha256"))}, keep=("fuid", "uid", "source", "seen_bytes", "total_bytes", "is_orig", "id.orig_h", "id.resp_h", "mime_type"))],
    "recmd_batch": [Variant(lambda r: truthy(r("KeyPath")) & ~two_valued(r.typed("Deleted", "boolean")), "registry", const("value_edit"), record_guid("registry", "HivePath", "KeyPath", "ValueName"), lambda r: markers.replace(r("LastWriteTimestamp"), " ", "T"), {"hive": of("HiveType"), "key": of("KeyPath"), "value": of("ValueName"), "data": registry_data, "type": of("ValueType"), "new_content": registry_data, "user": lambda r: markers.user_canon(markers.regex1(r("HivePath"), r"(?i)[/\\]Users[/\\]([^/\\]+)[/\\]"))}, keep=("HivePath", "HiveType", "Category", "Description", "Comment", "ValueType", "Deleted", "Recursive"))],
    "prefetch_dump": [Variant(lambda r: truthy(r("Executable")), "process", const("create"), record_guid("process", "Executable", "Hash"), of("LastRun"), {"exe": lambda r: markers.first(markers.win_program_name(r("Path")), r("Executable")), "image_path": lambda r: markers.win_program_path(r("Path"))}, keep=("SourceFilename", "SourceModified", "Executable", "Path", "Hash", "Version", "FileSize", "RunCount", "LastRun", "PreviousRuns", "FilesAccessed"))],
    "evtx_bits": [
        Variant(event("Bits-Client", 59, 60), "http", const("get"), windows_guid("http"), props={"url_full": data("url"), "url_domain": url_part(r"^https?://([^/?#]+)"), "url_scheme": url_part(r"^(https?)"), "url_remainder": url_part(r"^https?://[^/]+(/[^\s]*)"), "response_body_bytes": data("bytesTransferred"), **HOSTNAME}, native={k: data(k) for k in ("transferId", "name", "bytesTotal", "fileTime", "peer")}, **WINDOWS),
    ],
    "evtx_rdp": [
        Variant(event("TerminalServices-LocalSessionManager", 21, 24, 25), "user_session", lambda r: markers.map_value(r("EventId"), {"21": "login", "24": "logout", "25": "reconnect"}), windows_guid("user_session"), props={"user": lambda r: markers.user_canon(r.userdata("User")), "src_ip": lambda r: markers.regex1(r.userdata("Address"), r"^(?!LOCAL$)(.+)$"), **HOSTNAME}, native={k: child(k) for k in ("SessionID", "Address")}, **(WINDOWS | {"keep": (*WINDOWS_KEEP, "UserName")})),
    ],
    "evtx_more": [
        Variant(lambda r: event("Security", 4907)(r) & (r.payload("ObjectType") == "File"), "file", const("acl_modify"), windows_guid("file"), props={"file_path": data("ObjectName"), "file_name": name_of(data("ObjectName")), "extension": lambda r: markers.ext(r.payload("ObjectName")), "image_path": data("ProcessName"), "pid": lambda r: markers.hex_int(r.payload("ProcessId")), "user": user("SubjectUserName"), **NAMES}, native={k: data(k) for k in ("OldSd", "NewSd", "HandleId", "ObjectServer", "SubjectLogonId")}, owning_pid=data("ProcessId"), **CHANNEL),
        Variant(event("WMI-Activity", 5857), "module", const("load"), windows_guid("module"), props={"module_path": child("ProviderPath"), "module_name": name_of(child("ProviderPath")), "image_path": child("HostProcess"), "pid": child("ProcessID"), **NAMES}, native={k: child(k) for k in ("ProviderName", "Code")}, owning_pid=child("ProcessID"), **CHANNEL),
        Variant(event("System", 20003), "service", const("create"), windows_guid("service"), props={"name": child("ServiceName"), "image_path": child("DriverFileName"), "exe": name_of(child("DriverFileName")), **NAMES}, native={k: child(k) for k in ("DeviceInstanceID", "PrimaryService", "AddServiceStatus")}, **CHANNEL),
        Variant(event("SmbClient", 30803), "flow", const("start"), windows_guid("flow"), props={"dest_fqdn": data("ServerName"), "start_time": of("TimeCreated"), **NAMES}, native={k: data(k) for k in ("RemoteAddress", "LocalAddress", "Status", "Reason")}, **CHANNEL),
        Variant(event("System", 7001), "user_session", const("login"), windows_guid("user_session"), props={"uid": data("UserSid"), "login_successful": const("true"), **HOSTNAME}, native={"TSId": data("TSId")}, **CHANNEL),
        Variant(event("System", 7002), "user_session", const("logout"), windows_guid("user_session"), props={"uid": data("UserSid"), **HOSTNAME}, native={"TSId": data("TSId")}, **CHANNEL),
        Variant(event("System", 7034), "service", const("stop"), windows_guid("service"), props={"name": data("param1"), **NAMES}, native={"param2": data("param2")}, **CHANNEL),
    ],
    "l2t_filestat": [file_row(stamped(p), action, "l2t_filestat", made("shown"), STAT_NATIVE, True) for action, p in STAMPS.items()],
    "l2t_mft": [file_row(stamped(p), action, "l2t_mft", made("entry"), ENTRY_NATIVE) for action, p in STAMPS.items()],
    "l2t_usnjrnl": [file_row(gate, action, "l2t_usnjrnl", made("shown"), JOURNAL_NATIVE) for action, gate in (("create", reason_bit(0x100)), ("delete", reason_bit(0x200)), ("modify", lambda r: F.lit(True)))],
    **{m: [session_row(login_kind(6, 7), "login", m, LOGIN_NATIVE), session_row(login_kind(8), "logout", m, LOGIN_NATIVE)] for m in ("l2t_utmp", "l2t_utmpx")},
    "l2t_text": [session_row(lambda r: r.inner("data_type") == "syslog:ssh:login", "login", "l2t_text", ("data_type", "authentication_method", "protocol", "reporter", "hostname"), src_port=inner("port"))],
    "plaso_exec_prefetch": [execution(typed_as("windows:prefetch:execution"), "process", "plaso_exec_prefetch", {"exe": inner("executable"), "user": account(made("user"))}, "path_hints", "run_count", "prefetch_hash", "mapped_files", "volume_device_paths", "volume_serial_numbers", "number_of_volumes", "version")],
    "plaso_exec_winreg": [
        execution(both(AMCACHE, COMPILED), "file", "plaso_exec_winreg/amcache_link_time", file_at(inner("full_path")) | {"sha1_hash": FILE_SHA1, "company": inner("company_name")}, "key_path", "program_identifier", "file_reference", native={"compile_time": of("Timestamp")}, timestamp=nothing),
        execution(AMCACHE, "process", "plaso_exec_winreg/amcache", program(inner("full_path")) | {"sha1_hash": FILE_SHA1}, "key_path", "program_identifier", "file_reference"),
        execution(both(parsed_by("userassist"), lambda r: r.inner("value_name").rlike("^(?:UEME_RUNPATH:|(?!UEME_))")), "process", "plaso_exec_winreg/userassist", {"exe": name_of(made("run")), "image_path": part_of(made("run"), r"^(.*[\\/].*)$"), "user": account(made_first("user", "home"))}, "key_path", "value_name", "number_of_executions"),
        execution(parsed_by("(?:^|/)bam(?:/|$)"), "process", "plaso_exec_winreg/bam", program(inner("path")) | {"sid": inner("user_identifier")}, "key_path"),
        execution(parsed_by("appcompatcache"), "process", "plaso_exec_winreg/appcompatcache", program(inner("path")), "key_path", "entry_index", "control_set", native={"execution_inferred": const("true"), "time_meaning": lambda r: markers.first(markers.map_value(r.inner("timestamp_desc"), CACHE_TIMES), F.lit(CACHE_OTHER))}),
    ],
    "plaso_exec_cron": [execution(typed_as("syslog:cron:task_run"), "process", "plaso_exec_cron", {"exe": name_of(part_of(inner("command"), r"^(\S+)")), "image_path": part_of(inner("command"), r"^(/\S+)"), "command_line": inner("command"), "pid": inner("pid"), "user": inner("username")}, "reporter", "message_body", native=inners(syslog_hostname="hostname"), host=CRON_HOST, name=CRON_HOST)],
    "plaso_fseventsd": [disk_row(typed_as("macos:fseventsd:record"), "file", "modify", "plaso_fseventsd", file_at(inner("path")), inners("data_type", "flags", "event_identifier", "node_identifier", "timestamp_desc", "disk_id", "volume_id", artefact_sha256="sha256_hash"))],
    "plaso_pecoff": [binary(CREATED, "compile_time"), binary(WRITTEN, "pe_table_time"), binary(BINARY, None)],
    "plaso_olecf": [
        disk_row(both(DOCUMENT, gate), "file", action, "plaso_olecf", file_at(made("typed")) | {"sha256_hash": lowered(inner("sha256_hash")), "owner": inner("author")}, inners(*DOCUMENT_NATIVE, security_flags="security"))
        for action, gate in (("create", CREATED), ("modify", unless(CREATED)))
    ],
    "plaso_registry": [disk_row(lambda r: r.inner("data_type").startswith("windows:registry:"), "registry", "key_edit", "plaso_registry", {"key": inner("key_path"), "hive": inner("display_name"), "image_path": inner("image_path"), "user": account(made_first("user", "home"))}, inners(*REGISTRY_NATIVE))],
    "plaso_shellitem": [
        disk_row(both(SHELL_ITEM, gate), "file", action, "plaso_shellitem", file_at(made("shell")) | {"user": account(made_first("home", "shell_home"))} | ({"creation_time": of("Timestamp")} if action == "create" else {}), inners("data_type", "origin", "shell_item_path", "long_name", "name", "localized_name", *PROVENANCE, artefact_path="display_name", artefact_sha256="sha256_hash"))
        for action, gate in MOMENTS.items()
    ],
    "l2t_lnk": [
        disk_row(both(LINKED_FILE, gate), "file", action, "l2t_lnk", file_at(made("link")) | {"link_target": inner("link_target"), "user": account(made_first("user", "home", "link_home"))}, inners(*LINK_NATIVE, lnk_file="display_name", link_target_raw="link_target"))
        for action, gate in MOMENTS.items()
    ],
    "l2t_recyclebin": [disk_row(both(typed_as("windows:metadata:deleted_item"), stamped("(?i)deletion")), "file", "delete", "l2t_recyclebin", file_at(inner("original_filename")) | {"user": account(made_first("user", "deleted_home")), "uid": part_of(inner("display_name"), r"(?i)\$Recycle\.Bin[/\\](S-1-[0-9-]+)")}, inners("data_type", "file_size", "record_index", "drive_number", *PROVENANCE, artefact_file="display_name", artefact_sha256="sha256_hash"))],
    "l2t_srum": [
        disk_row(typed_as("windows:srum:network_usage"), "flow", "message", "l2t_srum/network_usage", used_by(inner("application"), made("device"), inner("user_identifier"), "uid") | inners(in_bytes="bytes_received", out_bytes="bytes_sent"), inners(*USAGE_NATIVE), host=const(""), name=None),
        disk_row(typed_as("windows:srum:application_usage"), "process", "create", "l2t_srum/application_usage", used_by(inner("application"), made("device"), inner("user_identifier"), "sid"), inners(*USAGE_NATIVE, "foreground_cycle_time", "foreground_bytes_read", "foreground_bytes_written", "face_time"), host=const(""), name=None),
    ],
    "l2t_msiecf": [disk_row(both(typed_as("msiecf:url"), lambda r: F.contains(r.inner("timestamp_desc"), F.lit("Last Visited"))), "http", "get", "l2t_msiecf", visited(made("visited")), inners("data_type", "number_of_hits", raw_url="url", artefact_file="display_name"))],
    "l2t_firefox_cache": [disk_row(typed_as("firefox:cache:record"), "http", lambda r: markers.map_value(r.inner("request_method"), {"GET": "get", "POST": "post", "PUT": "put"}, upper=True), "l2t_firefox_cache", visited(made("cached")) | {"response_status_code": lambda r: markers.hex_int(markers.regex1(r.inner("response_code"), r"\s(\d{3})\s"))}, inners("data_type", "fetch_count", "data_size", artefact_file="display_name"))],
    "l2t_firefox_places": [disk_row(typed_as("firefox:places:page_visited", "chrome:history:page_visited", "chrome:history:file_downloaded"), "http", "get", "l2t_firefox_places", visited(inner("url")) | {"request_referrer": either(part_of(inner("from_visit"), r"^(\S+)"), inner("from_visit")), "response_body_bytes": inner("received_bytes")}, inners("data_type", "title", "visit_count", "visit_type", "typed", "total_bytes", "full_path", artefact_file="display_name"))],
    "l2t_javaidx": [disk_row(typed_as("java:download:idx"), "http", "get", "l2t_javaidx", visited(inner("url")), inners("data_type", "ip_address", "idx_version", artefact_file="display_name"))],
    "esedump_srum": [
        Variant(lambda r: r("TableAlias") == "NetworkDataUsage", "flow", const("message"), record_guid("flow", "AppId", "UserId", "InterfaceLuid", "TimeStamp", "BytesSent", "BytesRecvd"), of("TimeStamp"), used_by(of("AppIdName"), part_of(of("AppIdName"), DEVICE_PATH), of("UserIdName"), "uid") | {"in_bytes": of("BytesRecvd"), "out_bytes": of("BytesSent")}, keep=(*USAGE_KEEP, "InterfaceLuid", "L2ProfileId", "L2ProfileFlags", "BytesSent", "BytesRecvd")),
        Variant(lambda r: r("TableAlias") == "ApplicationResourceUsage", "process", const("create"), record_guid("process", "AppId", "UserId", "TimeStamp"), of("TimeStamp"), used_by(of("AppIdName"), part_of(of("AppIdName"), DEVICE_PATH), of("UserIdName"), "sid"), keep=(*USAGE_KEEP, "ForegroundCycleTime", "BackgroundCycleTime", "FaceTime", "ForegroundBytesRead", "ForegroundBytesWritten", "BackgroundBytesRead", "BackgroundBytesWritten")),
    ],
    "jlecmd_dest": [Variant(lambda r: truthy(r("Path")), "file", const("read"), record_guid("file", "SourceFile", "EntryNumber"), of("LastModified"), file_at(of("Path")) | {"hostname": of("Hostname")}, host=of("Hostname"), keep=("AppId", "AppDescription", "InteractionCount", "CreatedOn", "EntryNumber", "MRUPosition", "Pinned", "MacAddress", "VolumeDroid", "SourceFile"))],
}

EVENT_LOG = ("evtx_security", "evtx_security_sessions", "evtx_process", "evtx_services", "evtx_sysmon", "evtx_bits", "evtx_rdp", "evtx_more")
#: File names to maps; the first pattern that a name contains decides. A pattern without maps is known and left raw.
ROUTES = [
    ("_EvtxECmd_Output", EVENT_LOG), ("goevtx.jsonl", EVENT_LOG), ("conn.json", ("zeek_conn",)), ("dns.json", ("zeek_dns",)), ("http.json", ("zeek_http",)), ("smtp.json", ("zeek_smtp",)),
    ("files.json", ("zeek_files",)), ("ssl.json", ("zeek_ssl",)), ("x509.json", ("zeek_x509",)), ("dhcp.json", ()), ("ntp.json", ()), ("snmp.json", ()), ("ocsp.json", ()), ("weird.json", ()), ("pe.json", ()), ("packet_filter.json", ()),
    (".L2tPrefetch", ("plaso_exec_prefetch",)), (".L2tWinreg", ("plaso_exec_winreg", "plaso_registry", "plaso_shellitem")), (".L2tSyslog", ("plaso_exec_cron", "l2t_text")), (".L2tCron", ("plaso_exec_cron",)),
    (".L2tFilestat", ("l2t_filestat",)), (".L2tMft", ("l2t_mft",)), (".L2tUsnjrnl", ("l2t_usnjrnl",)), (".L2tWinevt", ("l2t_winevt",)), (".L2tWinevtx", ("l2t_winevt",)), (".L2tMsiecf", ("l2t_msiecf",)),
    (".L2tFirefoxCache", ("l2t_firefox_cache",)), (".L2tSqlite", ("l2t_firefox_places",)), (".L2tJavaIdx", ("l2t_javaidx",)), (".L2tLnk", ("l2t_lnk", "plaso_shellitem")), (".L2tRecycleBinInfo2", ("l2t_recyclebin",)),
    (".L2tRecycleBin", ("l2t_recyclebin",)), (".L2tPe", ("plaso_pecoff",)), (".L2tOlecf", ("plaso_olecf",)), (".L2tRplog", ()), (".L2tFseventsd", ("plaso_fseventsd",)), (".L2tEsedb", ("l2t_srum",)),
    ("_RECmd_Batch_", ("recmd_batch",)), ("jlecmd_AutomaticDestinations", ("jlecmd_dest",)), ("jlecmd_CustomDestinations", ()), ("_LECmd_Output", ()), ("recmd_batch.json", ("recmd_batch",)), ("NetworkDataUsage", ("esedump_srum",)),
    ("ApplicationResourceUsage", ("esedump_srum",)), ("PrefetchDump_Output", ("prefetch_dump",)), ("gore.jsonl", ("recmd_batch",)), ("goprefetch.jsonl", ("prefetch_dump",)), ("gojle.jsonl", ("jlecmd_dest",)), ("goese.jsonl", ()),
    ("gomft.jsonl", ()), ("gole.jsonl", ()), ("gorb.jsonl", ()), ("gosbe.jsonl", ()), ("goamcache.jsonl", ()), ("goappcompat.jsonl", ()), ("gowxt.jsonl", ()), (".L2tUtmp", ("l2t_utmp",)), (".L2tUtmpx", ("l2t_utmpx",)), (".L2tText", ("l2t_text",)),
]


#: Names of routes whose records are brought into another shape first: how, and the maps that then read them.
ADAPTERS: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "l2t_winevt": (adapters.winevt, EVENT_LOG),
    "jlecmd_dest": (adapters.jump_lists, ("jlecmd_dest",)),
}


def pattern_of(path: str) -> tuple[str, tuple[str, ...]] | None:
    """The first pattern that the file's name contains. A .jsonl file that is named for its asset goes by its folder's name."""
    folder, _, name = path.rpartition("/")
    tried = [name, folder.rpartition("/")[2] + ".jsonl"] if name.endswith(".jsonl") else [name]
    return next(((pattern, names) for n in tried for pattern, names in ROUTES if pattern in n), None)


def known(path: str) -> bool:
    return pattern_of(path) is not None


def route(path: str) -> list[str]:
    """The maps, or the adapter, for a file; none for an unknown or a raw one."""
    found = pattern_of(path)
    return [m for m in found[1] if m in MAPS or m in ADAPTERS] if found else []


def mapped(records: DataFrame, names: list[str], default_host: str | None = None) -> DataFrame:
    """Events of the records of a file with these routes."""
    if len(names) == 1 and names[0] in ADAPTERS:
        adapt, read = ADAPTERS[names[0]]
        return apply(adapt(records), {n: MAPS[n] for n in read}, default_host)
    return apply(records, {n: MAPS[n] for n in names}, default_host)
