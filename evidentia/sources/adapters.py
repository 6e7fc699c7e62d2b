"""Records of one tool in the shape that another tool's maps read."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import times
from evidentia.functions.blanks import nb

#: What the positions of an event's strings mean, by a word of its channel or source and its number. Of several that
#: fit the first one counts. An underscore is a position that no map reads.
SUBJECT = ["SubjectUserSid", "SubjectUserName", "SubjectDomainName", "SubjectLogonId"]
TARGET = ["TargetUserSid", "TargetUserName", "TargetDomainName"]
NAMED = ["LogonType", "LogonProcessName", "AuthenticationPackageName", "WorkstationName"]
FROM = ["TransmittedServices", "LmPackageName", "KeyLength", "ProcessId", "ProcessName", "IpAddress", "IpPort"]
CLIENT = ["AccountName", "AccountDomain", "LogonID", "SessionName", "ClientName", "ClientAddress"]
MONITORED = ["RuleName", "UtcTime", "ProcessGuid", "ProcessId", "Image"]
REGISTRY = ["RuleName", "EventType", "UtcTime", "ProcessGuid", "ProcessId", "Image", "TargetObject"]
TRANSFER = ["transferId", "name", "Id", "url", "peer", "_", "fileTime", "fileLength", "bytesTotal", "bytesTransferred"]
LAYOUTS = [
    ("Security", 4624, [*SUBJECT, *TARGET, "TargetLogonId", *NAMED, "LogonGuid", *FROM]),
    ("Security", 4625, [*SUBJECT, *TARGET, "Status", "FailureReason", "SubStatus", *NAMED, *FROM]),
    ("Security", 4634, [*TARGET, "TargetLogonId", "LogonType"]),
    ("Security", 4647, [*TARGET, "TargetLogonId"]),
    ("Security", 4672, [*SUBJECT, "PrivilegeList"]),
    ("Security", 4688, [*SUBJECT, "NewProcessId", "NewProcessName", "TokenElevationType", "ProcessId", "CommandLine", *TARGET, "TargetLogonId", "ParentProcessName", "MandatoryLabel"]),
    ("Security", 4697, [*SUBJECT, "ServiceName", "ServiceFileName", "ServiceType", "ServiceStartType", "ServiceAccount"]),
    ("Security", 4778, CLIENT),
    ("Security", 4779, CLIENT),
    ("System", 7045, ["ServiceName", "ImagePath", "ServiceType", "StartType", "AccountName"]),
    ("Bits-Client", 59, TRANSFER),
    ("Bits-Client", 60, TRANSFER),
    ("TerminalServices", 21, ["User", "SessionID", "Address"]),
    ("TerminalServices", 24, ["User", "SessionID", "Address"]),
    ("TerminalServices", 25, ["User", "SessionID", "Address"]),
    ("Sysmon", 1, [*MONITORED, "FileVersion", "Description", "Product", "Company", "CommandLine", "CurrentDirectory", "User", "LogonGuid", "LogonId", "TerminalSessionId", "IntegrityLevel", "Hashes", "ParentProcessGuid", "ParentProcessId", "ParentImage", "ParentCommandLine"]),
    ("Sysmon", 3, [*MONITORED, "User", "Protocol", "Initiated", "SourceIsIpv6", "SourceIp", "SourceHostname", "SourcePort", "SourcePortName", "DestinationIsIpv6", "DestinationIp", "DestinationHostname", "DestinationPort", "DestinationPortName"]),
    ("Sysmon", 5, MONITORED),
    ("Sysmon", 6, ["RuleName", "UtcTime", "ImageLoaded", "Hashes", "Signed", "Signature", "SignatureStatus"]),
    ("Sysmon", 7, [*MONITORED, "ImageLoaded", "FileVersion", "Description", "Product", "Company", "Hashes", "Signed", "Signature", "SignatureStatus"]),
    ("Sysmon", 8, ["RuleName", "UtcTime", "SourceProcessGuid", "SourceProcessId", "SourceImage", "TargetProcessGuid", "TargetProcessId", "TargetImage", "NewThreadId", "StartAddress", "StartModule", "StartFunction"]),
    ("Sysmon", 11, [*MONITORED, "TargetFilename", "CreationUtcTime"]),
    ("Sysmon", 12, REGISTRY),
    ("Sysmon", 13, [*REGISTRY, "Details"]),
    ("Sysmon", 23, ["RuleName", "UtcTime", "ProcessGuid", "ProcessId", "User", "Image", "TargetFilename", "Hashes", "IsExecutable", "Archived"]),
]
#: Fixed value: the channel whose events name their values below UserData.
USER_DATA = "TerminalServices"


def layouts() -> Column:
    """The layouts as a constant map from event number to those that there are for it."""
    table = defaultdict(list)
    for word, number, names in LAYOUTS:
        table[str(number)].append({"word": word, "names": names})
    return F.from_json(F.lit(json.dumps(table)), "map<string, array<struct<word: string, names: array<string>>>>")


def part(record: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, path, kind)


def winevt(records: DataFrame, record: str = "record") -> DataFrame:
    """Event log rows of a timeline as records of the event log maps; rows without a layout stay as they are.

    The strings of an event have no names there: its number, and a word of its channel or source, tell what they mean. Missing
    positions are null. A number written as text has no layout. The computer is that of the row, else of its XML.
    """
    text = lambda key: F.nullif(part(record, f"$.Record.{key}"), F.lit(""))
    of_xml = lambda tag: F.nullif(F.regexp_extract(text("xml_string"), f"<{tag}>([^<]+)</{tag}>", 1), F.lit(""))
    number = F.when(F.schema_of_variant(part(record, "$.Record.event_identifier", "variant")) != "STRING", part(record, "$.Record.event_identifier", "double"))
    told = {"_channel": of_xml("Channel"), "_source": text("source_name"), "_computer": F.coalesce(text("computer_name"), text("hostname"), of_xml("Computer")), "_number": number}
    wide = records.withColumns(told)
    where = F.concat_ws(" ", F.coalesce("_channel", F.lit("")), F.coalesce("_source", F.lit("")))
    whole = F.when(F.col("_number") == F.floor("_number"), F.floor("_number").cast("string"))
    layout = F.try_element_at(F.filter(F.try_element_at(layouts(), whole), lambda x: F.contains(where, x["word"])), F.lit(1))
    wide = wide.withColumn("_layout", layout).withColumn("_strings", part(record, "$.Record.strings", "array<string>"))
    pairs = F.filter(F.transform(F.col("_layout.names"), lambda name, k: F.struct(name.alias("@Name"), F.get(F.col("_strings"), k).alias("#text"))), lambda x: x["@Name"] != "_")
    named = F.to_json(F.struct(F.struct(pairs.alias("Data")).alias("EventData")))
    below = F.to_json(F.struct(F.struct(F.map_from_entries(pairs).alias("EventXML")).alias("UserData")))
    made = F.struct(
        F.col("_number").cast("int").alias("EventId"), F.coalesce("_source", F.lit("")).alias("Provider"), F.coalesce("_channel", "_source", F.lit("")).alias("Channel"), F.col("_computer").alias("Computer"),
        part(record, "$.Record.record_number").alias("EventRecordId"), part(record, "$.Timestamp").alias("TimeCreated"), F.when(F.col("_layout.word") == USER_DATA, below).otherwise(named).alias("Payload"),
        part(record, "$.Record.display_name").alias("SourceFile"),
    )
    return wide.withColumn(record, F.when(F.col("_layout").isNotNull(), F.to_variant_object(made)).otherwise(F.col(record))).drop(*told, "_layout", "_strings")


#: Keys of a jump list's entry, and of its dates, that its flat record has.
ENTRY = ["Path", "Hostname", "InteractionCount", "EntryNumber", "MRUPosition", "Pinned", "MacAddress", "VolumeDroid"]
ENTRY_DATES = ["LastModified", "CreatedOn"]


def dotnet_date(value: Column) -> Column:
    """/Date(milliseconds)/ as an ISO time; another text as it is, a blank one null."""
    milliseconds = F.regexp_extract(value, r"/Date\((-?\d+)\)/", 1)
    return F.when(milliseconds != "", times.epoch_ts(milliseconds.try_cast("double") / 1000)).otherwise(nb(value))


def jump_lists(records: DataFrame, record: str = "record") -> DataFrame:
    """A record for each entry of a jump list, with the program that the list belongs to; a list without entries gives none."""
    entries = part(record, "$.DestListEntries", "array<variant>")
    rows = records.withColumn("_entry", F.explode(entries)).where(F.schema_of_variant("_entry").startswith("OBJECT"))
    own = [part("_entry", f"$.{k}", "variant").alias(k) for k in ENTRY] + [dotnet_date(part("_entry", f"$.{k}")).alias(k) for k in ENTRY_DATES]
    program = [part(record, "$.AppId.AppId").alias("AppId"), part(record, "$.AppId.Description").alias("AppDescription"), part(record, "$.SourceFile").alias("SourceFile")]
    return rows.withColumn(record, F.to_variant_object(F.struct(*own, *program))).drop("_entry")
