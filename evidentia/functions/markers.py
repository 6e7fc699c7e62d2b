"""Column builders of the mapping language. Blank inputs give null unless a builder says otherwise."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.blanks import bound, nb

#: Account names of well-known security identifiers.
WELL_KNOWN_SIDS = {
    "S-1-0-0": "NULL SID", "S-1-1-0": "EVERYONE", "S-1-2-0": "LOCAL", "S-1-3-0": "CREATOR OWNER", "S-1-3-1": "CREATOR GROUP", "S-1-5-7": "ANONYMOUS LOGON",
    "S-1-5-11": "AUTHENTICATED USERS", "S-1-5-18": "SYSTEM", "S-1-5-19": "LOCAL SERVICE", "S-1-5-20": "NETWORK SERVICE", "S-1-5-32-544": "ADMINISTRATORS",
    "S-1-5-32-545": "USERS", "S-1-5-32-546": "GUESTS", "S-1-5-32-547": "POWER USERS", "S-1-5-32-551": "BACKUP OPERATORS", "S-1-5-32-555": "REMOTE DESKTOP USERS",
}
#: The names of the same accounts, in upper case.
WELL_KNOWN_NAMES = {
    "SYSTEM": "SYSTEM", "LOCAL SYSTEM": "SYSTEM", "LOCALSYSTEM": "SYSTEM", "SYSTEMPROFILE": "SYSTEM", "LOCAL SERVICE": "LOCAL SERVICE", "LOCALSERVICE": "LOCAL SERVICE",
    "NETWORK SERVICE": "NETWORK SERVICE", "NETWORKSERVICE": "NETWORK SERVICE", "ADMINISTRATORS": "ADMINISTRATORS", "EVERYONE": "EVERYONE",
    "ANONYMOUS LOGON": "ANONYMOUS LOGON", "AUTHENTICATED USERS": "AUTHENTICATED USERS",
}


def first(*values: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*(nb(v) for v in values))


def concat(*parts: Column) -> Column:
    """All parts joined; null if any is blank."""
    return F.concat(*(nb(p) for p in parts))


def basename(path: Column) -> Column:
    """Last component: by backslashes, drive left out, where the path has one, else by slashes; null if empty."""
    return bound(bound(nb(path), last_component), lambda tail: F.when(tail != "", tail))


def last_component(path: Column) -> Column:
    windows = F.regexp_replace(path, r"^(\\\\[^\\/]+[\\/][^\\/]+|[A-Za-z]:)", "")
    return F.when(F.contains(path, F.lit("\\")), F.regexp_extract(windows, r"([^\\/]*)\z", 1)).otherwise(F.regexp_extract(path, r"([^/]*)\z", 1))


def ext(path: Column) -> Column:
    """Lower-case suffix of the last component; dots at its start begin no suffix."""
    return bound(F.lower(F.regexp_extract(basename(path), r"^\.*[^.].*\.([^.]*)\z", 1)), lambda e: F.when(e != "", e))


def lower(value: Column) -> Column:
    return F.lower(nb(value))


def regex1(value: Column, pattern: str) -> Column:
    """First group of the first match; null without one."""
    return bound(value, lambda v: F.when(nb(v).rlike(pattern), F.regexp_extract(v, pattern, 1)))


def domain_of(value: Column) -> Column:
    """What follows the first @, up to a slash, in lower case."""
    v = nb(value)
    return F.nullif(F.lower(F.regexp_extract(v, "@([^/]*)", 1)), F.lit(""))


def host_label(value: Column) -> Column:
    return F.nullif(F.split_part(nb(value), F.lit("."), F.lit(1)), F.lit(""))


def exe_path(command: Column) -> Column:
    """The program of a command line: what is quoted, else up to the first .exe, else the first word."""
    return bound(F.trim(nb(command)), program_of)


def program_of(c: Column) -> Column:
    quoted = F.regexp_extract(c, '^"([^"]+)"', 1)
    upto = F.regexp_extract(c, r"(?i)^(.*?\.exe)", 1)
    return F.when(quoted != "", quoted).when(upto != "", upto).otherwise(F.nullif(F.split_part(c, F.lit(" "), F.lit(1)), F.lit("")))


def map_value(value: Column, table: Mapping[str, str], upper: bool = False) -> Column:
    """The table's entry; null for what it has not."""
    key = F.upper(nb(value)) if upper else nb(value)
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def unescape_backslashes(value: Column) -> Column:
    return F.replace(nb(value), F.lit("\\\\"), F.lit("\\"))


def replace(value: Column, old: str, new: str) -> Column:
    return F.replace(nb(value), F.lit(old), F.lit(new))


def at(values: Column, index: int) -> Column:
    """Trimmed element; negative indices count from the end; blank or absent is null."""
    return nb(F.trim(F.try_element_at(values, F.lit(index + 1 if index >= 0 else index))))


def hex_int(value: Column) -> Column:
    """An integer as written: decimal if it can be, else hexadecimal with or without 0x; single underscores between digits are allowed.

    Null for what is no integer, or none of 64 bits.
    """
    return bound(F.trim(nb(value)), integer_of)


def integer_of(v: Column) -> Column:
    decimal = F.when(v.rlike(r"^[+-]?\d+(?:_\d+)*$"), F.replace(v, F.lit("_"), F.lit("")).try_cast("bigint"))
    # the sign apart: a conversion of bases takes a negative number for a large one
    digits = F.regexp_replace(F.replace(F.regexp_replace(v, "^[+-]?(?:0[xX]_?)?", ""), F.lit("_"), F.lit("")), "^0+(?=.)", "")
    size = F.conv(digits, 16, 10).try_cast("bigint")
    hexadecimal = F.when(v.rlike("^[+-]?(?:0[xX]_?)?[0-9A-Fa-f]+(?:_[0-9A-Fa-f]+)*$") & (F.length(digits) <= 16), F.when(v.startswith("-"), -size).otherwise(size))
    return F.coalesce(decimal, hexadecimal)


def has_bit(value: Column, bit: int) -> Column:
    return value.try_cast("bigint").bitwiseAND(bit) != 0


def win_program_path(value: Column) -> Column:
    """The value unless it is a tab-separated package descriptor."""
    return F.when(~F.contains(nb(value), F.lit("\t")), value)


def win_program_name(value: Column) -> Column:
    """Name of a package descriptor (parts four and five), else the last component of the path."""
    parts = F.filter(F.split(value, "\t"), lambda x: x != "")
    descriptor = F.contains(nb(value), F.lit("\t")) & (F.size(parts) >= 6) & F.contains(F.try_element_at(parts, F.lit(4)), F.lit("."))
    return F.when(descriptor, F.concat_ws("_", F.try_element_at(parts, F.lit(4)), F.try_element_at(parts, F.lit(5)))).otherwise(basename(value))


def user_canon(value: Column) -> Column:
    """One name for well-known accounts: identifiers named, authority prefixes dropped; domain accounts stay as they are."""
    return bound(bound(F.trim(nb(value)), lambda v: F.when(v != "", v)), account_of)


def account_of(v: Column) -> Column:
    local = F.regexp_extract(v, r"(?is)^\s*(?:NT AUTHORITY|BUILTIN)\s*\\(.*)$", 1)
    bare = F.when(F.contains(v, F.lit("\\")), bound(local, lambda x: F.when(x != "", x))).otherwise(v)
    known = bound(bare, lambda b: F.coalesce(map_value(F.trim(b), WELL_KNOWN_NAMES, upper=True), b))
    return F.coalesce(map_value(v, WELL_KNOWN_SIDS, upper=True), known, v)


#: What ``parsed`` and then ``cleaned`` add to a record, so that its payload is parsed, and its values cleaned, once however many fields are read from it.
PARSED = {"data": "payload_data", "plain": "payload_plain", "user": "payload_user"}
CLEANED = {"values": "payload_values", "children": "payload_children"}
BAG = "map<string,string>"


def parsed(blob: Column) -> dict[str, Column]:
    """The named values of an event's Data list, its plain keys, and the children of its UserData, by column name."""
    listed = F.from_json(blob, "EventData STRUCT<Data: ARRAY<STRUCT<`@Name`: STRING, `#text`: STRING>>>")["EventData"]["Data"]
    return {
        PARSED["data"]: F.filter(listed, lambda x: x["@Name"].isNotNull()), PARSED["plain"]: F.from_json(blob, "MAP<STRING, STRING>"),
        PARSED["user"]: F.when(F.contains(blob, F.lit('"UserData"')), F.map_values(F.from_json(blob, "UserData MAP<STRING, MAP<STRING, STRING>>")["UserData"])),
    }


def bag_of(pairs: Column) -> Column:
    """A map of (name, value) pairs, of a name that comes several times the last one."""
    return bound(pairs, bag_of_made)


def bag_of_made(pairs: Column) -> Column:
    empty = F.create_map().cast(BAG)
    several = F.aggregate(pairs, empty, lambda have, p: F.map_concat(F.map_filter(have, lambda k, v: k != p["key"]), F.map_from_arrays(F.array(p["key"]), F.array(p["value"]))))
    names = F.transform(pairs, lambda p: p["key"])
    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_entries(pairs)).otherwise(several)


def tidy(values: Column) -> Column:
    """Values by name, trimmed; blank ones left out."""
    return F.map_filter(F.transform_values(values, lambda k, v: F.trim(v)), lambda k, v: ~v.isin("", "-"))


def cleaned(columns: dict[str, Column]) -> dict[str, Column]:
    """Trimmed values by name, blank ones left out: of the Data list, or plain keys that it has no value for; and of the first child with the key."""
    empty = F.create_map().cast(BAG)
    data = F.coalesce(columns[PARSED["data"]], F.array().cast("array<struct<`@Name`:string,`#text`:string>>"))
    last = F.transform(data, lambda x: F.struct(x["@Name"].alias("key"), x["#text"].alias("value")))
    own = F.map_filter(bag_of(last), lambda k, v: v.isNotNull())
    plain = F.coalesce(columns[PARSED["plain"]], empty)
    # made once: it is read again for every plain key
    values = bound(own, lambda own: F.when(F.size(own) == 0, plain).otherwise(F.map_concat(F.map_filter(plain, lambda k, v: ~F.map_contains_key(own, k) & (k != "EventData")), own)))
    children = F.aggregate(columns[PARSED["user"]], empty, lambda have, child: F.map_concat(have, F.map_filter(F.coalesce(child, empty), lambda k, v: ~F.map_contains_key(have, k))))
    return {CLEANED["values"]: tidy(values), CLEANED["children"]: tidy(children)}


def payload(blob: Column, field: str) -> Column:
    """A named value of an event's JSON payload: of its Data list (the last of a name wins), else a plain key."""
    return F.try_element_at(cleaned(parsed(blob))[CLEANED["values"]], F.lit(field))


def userdata(blob: Column, field: str) -> Column:
    """The value of the first child of UserData that has the key."""
    return F.try_element_at(cleaned(parsed(blob))[CLEANED["children"]], F.lit(field))
