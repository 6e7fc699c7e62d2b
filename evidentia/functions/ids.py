"""Deterministic identities: name-based UUIDs, canonical JSON keys, document ids, and native identifiers in texts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.blanks import nb, unidentified

#: Default namespace of minted identities; pass another to reproduce other registries.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "evidentia.example")


def sha1_of_name(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    return F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))


#: Each digit with that of the variant which it makes.
VARIANTS = "".join(f"{d:x}{8 + d % 4:x}" for d in range(16))


def uuid_of_sha1(h: Column) -> Column:
    """The version 5 UUID that a hash makes; null of none. The hash is written once, so that it is made once; its digit of the variant is looked up in what is put behind it."""
    parts = "^(.{8})(.{4}).(.{3})(.)(.{3})(.{12}).*#(?:..)*?\\4(.).*$"
    return F.regexp_replace(F.concat(h, F.lit(f"#{VARIANTS}")), parts, "$1-$2-5$3-$7$5-$6")


def uuid5(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """Version 5 UUID of a text, with built-in functions; null of none."""
    return uuid_of_sha1(sha1_of_name(name, namespace))


def canonical_json(values: Mapping[str, Column]) -> Column:
    """JSON object with sorted keys and no blanks, values as they are typed; null where a value is."""
    names = sorted(values)
    text = F.to_json(F.struct(*(values[n].alias(n) for n in names)))
    whole = values[names[0]].isNotNull()
    for n in names[1:]:
        whole = whole & values[n].isNotNull()
    return F.when(whole, text)


def minted(kind: str, version: int, parts: Mapping[str, Column], fallback: Mapping[str, Column] | None = None, namespace: uuid.UUID = NAMESPACE) -> Column:
    """Identity over named components; with a blank one, over the position in the evidence; null if that is blank too."""
    fixed = {"_obj": F.lit(kind), "_v": F.lit(version)}
    key = lambda values: canonical_json(fixed | {k: nb(v.cast("string")) for k, v in values.items()})
    return uuid5(F.coalesce(key(parts), key(fallback)) if fallback else key(parts), namespace)


def fields_guid(kind: str, *fields: Column) -> Column:
    """<kind>-a-b-c; any null voids it, an empty text does not."""
    return F.concat(F.lit(kind), *(x for f in fields for x in (F.lit("-"), f.cast("string"))))


def document_id(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def volume_guids(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"(?i)Volume\{([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})\}"), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def mac_addresses(text: Column) -> Column:
    """Literal addresses, in lower case with colons; multicast ones left out."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9A-Fa-f:-])([0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5})(?![0-9A-Fa-f:-])"), F.lit(1))
    own = F.transform(found, lambda m: F.lower(F.replace(m, F.lit("-"), F.lit(":"))))
    return F.array_distinct(F.filter(own, lambda m: F.conv(F.substring(m, 1, 2), 16, 10).cast("int") % 2 == 0))


def usb_serials(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"(?i)USBSTOR[\\#][^\\#]*Ven_[^\\#]*[\\#]([^\\#&]+)&0"), F.lit(1))
    return F.array_distinct(F.transform(found, F.upper))


def asset_id(serial: Column, volume: Column, sha256: Column, name: Column) -> Column:
    """The first identity that an asset has, in the order of their strength."""
    known = lambda c: F.when(~unidentified(c), F.trim(c))
    return F.coalesce(known(serial), known(volume), known(sha256), clean_name(name))


def clean_name(name: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.trim(name)), r"[^a-z0-9._-]+", "-"), F.lit(""))


def technique_ids(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"(?i)\b(T\d{4}(?:[._]\d{3})?)\b"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda t: F.upper(F.replace(t, F.lit("_"), F.lit(".")))))


def is_ip(value: Column) -> Column:
    """An IPv4 or IPv6 literal."""
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    four = f"^{octet}(?:\\.{octet}){{3}}$"
    group = "[0-9A-Fa-f]{1,4}"
    six = f"^(?:(?:{group}:){{7}}{group}|(?=(?:.*::))(?!.*::.*::)(?!(?:.*:){{8}})(?:(?:{group})?(?::(?:{group})?)*))$"
    return F.coalesce(value.rlike(four) | (F.contains(value, F.lit(":")) & value.rlike(six)), F.lit(False))


def native_first(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))
