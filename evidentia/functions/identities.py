"""The registry of minted identities: what names an event of a timeline row, and what may be equated by it.

An identity is a version 5 UUID over a key: the object, the version of the entry, and its components by name. Where a
component is blank, the row's place in the evidence is the key instead; such an identity holds in its own source only.
Events carry the key, its scope and the place in their native bag, so that every identity can be minted again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.blanks import nb, two_valued
from evidentia.functions.ids import canonical_json, sha1_of_name, uuid_of_sha1

#: Fixed value: the namespace of these identities, itself the version 5 UUID of a name of their registry.
SPACE = uuid.UUID("afab0259-176f-58d2-9e88-8f508fb46232")
VERSION = 1
INTRINSIC, POSITIONAL = "intrinsic", "positional"
KEY, SCOPE, PLACE = "spindle_key", "spindle_scope", "spindle_ref"
POSITION = ("SourceImage", "RecordId")


@dataclass(frozen=True)
class Entry:
    """An identity's object and its components: name in the key, and the event's column or key of the native bag."""

    kind: str
    parts: Mapping[str, str]


VISIT = Entry("http", {"db_path": "native.artefact_file", "url": "url_full", "visit_time": "timestamp"})
FILE_AT = Entry("file", {"file_path": "file_path", "event_time": "timestamp"})
TERMINAL = Entry("user_session", {"pid": "owning_pid", "terminal": "native.terminal", "event_time": "timestamp"})
PROGRAM = Entry("process", {"image_path": "image_path", "recorded_time": "timestamp"})

#: The identities by map, and by kind of row where a map has several.
ENTRIES: dict[str, Entry] = {
    "l2t_filestat": FILE_AT,
    "l2t_firefox_cache": VISIT,
    "l2t_firefox_places": VISIT,
    "l2t_javaidx": VISIT,
    "l2t_lnk": Entry("file", {"lnk_file": "native.lnk_file", "file_path": "file_path", "event_time": "timestamp"}),
    "l2t_mft": Entry("file", {"file_reference": "native.file_reference", "event_time": "timestamp"}),
    "l2t_msiecf": VISIT,
    "l2t_recyclebin": Entry("file", {"artefact_file": "native.artefact_file", "file_path": "file_path", "event_time": "timestamp"}),
    "l2t_srum/application_usage": Entry("process", {"application": "native.application", "user_identifier": "native.user_identifier", "recorded_time": "timestamp"}),
    "l2t_srum/network_usage": Entry("flow", {"application": "native.application", "user_identifier": "native.user_identifier", "interface_luid": "native.interface_luid", "recorded_time": "timestamp"}),
    "l2t_text": Entry("user_session", {"pid": "owning_pid", "user": "user", "event_time": "timestamp"}),
    "l2t_usnjrnl": Entry("file", {"usn": "native.update_sequence_number", "file_reference": "native.file_reference"}),
    "l2t_utmp": TERMINAL,
    "l2t_utmpx": TERMINAL,
    "plaso_exec_cron": Entry("process", {"command": "command_line", "pid": "pid", "event_time": "timestamp"}),
    "plaso_exec_prefetch": Entry("process", {"exe": "exe", "prefetch_hash": "native.prefetch_hash", "run_time": "timestamp"}),
    "plaso_exec_winreg/amcache": PROGRAM,
    "plaso_exec_winreg/amcache_link_time": Entry("file", {"file_path": "file_path", "sha1": "sha1_hash"}),
    "plaso_exec_winreg/appcompatcache": PROGRAM,
    "plaso_exec_winreg/bam": Entry("process", {"key_path": "native.key_path", "image_path": "image_path", "event_time": "timestamp"}),
    "plaso_exec_winreg/userassist": Entry("process", {"key_path": "native.key_path", "value_name": "native.value_name", "event_time": "timestamp"}),
    "plaso_fseventsd": Entry("file", {"event_identifier": "native.event_identifier", "file_path": "file_path"}),
    "plaso_olecf": FILE_AT,
    "plaso_pecoff": Entry("file", {"file_path": "file_path", "sha256": "sha256_hash"}),
    "plaso_registry": Entry("registry", {"hive": "hive", "key_path": "key", "last_write": "timestamp"}),
    "plaso_shellitem": Entry("file", {"origin": "native.origin", "file_path": "file_path", "event_time": "timestamp"}),
}


def key_of(kind: str, parts: Mapping[str, Column]) -> Column:
    """The key of an object's components, in its one spelling; null where a component is blank."""
    return canonical_json({"_obj": F.lit(kind), "_v": F.lit(VERSION)} | {k: nb(v.cast("string")) for k, v in parts.items()})


def complete(parts: Mapping[str, Column]) -> Column:
    """Whether no component is blank, so that the key of them is there."""
    return reduce(lambda a, b: a & b, (nb(v.cast("string")).isNotNull() for v in parts.values()))


def stamps(name: str, value: Callable[[str], Column], place: Callable[[str], Column]) -> dict[str, Column]:
    """What an event of an entry carries in its native bag: key, scope and place; no key and scope without components and place."""
    entry = ENTRIES[name]
    own, fallback = {k: value(source) for k, source in entry.parts.items()}, {k: place(k) for k in POSITION}
    # the keys are made for one of the three only
    scope = F.when(complete(own), INTRINSIC).when(complete(fallback), POSITIONAL)
    return {KEY: F.coalesce(key_of(entry.kind, own), key_of(entry.kind, fallback)), SCOPE: scope, PLACE: F.to_json(F.struct(*(F.coalesce(place(k), F.lit("")).alias(k) for k in POSITION)))}


def hash_of(key: Column) -> Column:
    return sha1_of_name(key, SPACE)


def guid_of(key: Column) -> Column:
    return uuid_of_sha1(hash_of(key))


def known_keys(artefact: Column, kind: Column, names: Column) -> Column:
    """Whether an artefact has an entry for an object with these names of components, whatever their order."""
    entry = lambda n, e: (F.split_part(F.lit(n), F.lit("/"), F.lit(1)) == artefact) & (kind == e.kind) & (names == F.array(*(F.lit(k) for k in sorted(e.parts))))
    tests = [entry(n, e) for n, e in ENTRIES.items()]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return two_valued(out)


def part_names(key: Column) -> Column:
    return F.array_sort(F.array_except(F.json_object_keys(key), F.array(F.lit("_obj"), F.lit("_v"))))


def equatable(guid: Column, kind: Column, artefact: Column, native: Column) -> Column:
    """Whether an event may be equated with another source's by its identity: an identity of a tool, or a minted one over an entry's components."""
    bag = lambda k: F.try_element_at(native, F.lit(k))
    of_tool = bag(KEY).isNull() & bag(SCOPE).isNull()
    version = F.get_json_object(bag(KEY), "$._v") == str(VERSION)
    minted = (bag(SCOPE) == INTRINSIC) & version & known_keys(artefact, kind, part_names(bag(KEY)))
    return two_valued((guid != "") & (of_tool | minted))


def problems(guid: Column, kind: Column, artefact: Column, native: Column) -> Column:
    """What is wrong with a minted identity, as a list of words; empty for a sound one."""
    bag = lambda k: F.try_element_at(native, F.lit(k))
    key, scope, names = bag(KEY), bag(SCOPE), part_names(bag(KEY))
    tests = {
        "key": F.get_json_object(key, "$._obj").isNotNull(),
        "object": F.get_json_object(key, "$._obj") == kind,
        "version": F.get_json_object(key, "$._v") == str(VERSION),
        "scope": scope.isin(INTRINSIC, POSITIONAL),
        "place": F.array_sort(F.json_object_keys(bag(PLACE))) == F.array(*(F.lit(k) for k in sorted(POSITION))),
        "guid": guid == guid_of(key),
        "position": (scope != POSITIONAL) | (names == F.array(*(F.lit(k) for k in sorted(POSITION)))),
        "entry": (scope != INTRINSIC) | known_keys(artefact, kind, names),
    }
    return F.array_compact(F.array(*(F.when(~two_valued(t), name) for name, t in tests.items())))
