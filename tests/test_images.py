"""Maps of disk images' rows and their minted identities."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from evidentia.functions import identities
from evidentia.plans import maps

#: Identities that other implementations of the registry mint for these components, in the entry's order.
PINNED = [
    ("l2t_filestat", ("\\Program Files\\app\\FPEXT.MSG", "2020-09-16T13:14:30.462820Z"), "fef81767-4b0e-540a-a830-031b85f14bcc"),
    ("l2t_lnk", ("NTFS:\\Documents and Settings\\Jo\\Desktop\\OpenOffice.org.lnk", "C:\\Program Files\\OO3\\soffice.exe", "2009-11-20T19:13:29.625000Z"), "f686d851-c7c8-5ad5-afa0-4ca78a50fd2d"),
    ("l2t_mft", ("843", "2020-09-16T13:14:30.462820Z"), "068d2085-7fa8-5c23-b8a0-708ad624c773"),
    ("l2t_srum/network_usage", ("DiagTrack", "S-1-5-21-1-2-3-1001", "19985273102270464", "2018-03-27T12:19:00Z"), "46be4a7e-d922-5388-81a5-585aa3b1e738"),
    ("l2t_text", ("3756", "insec", "2020-09-16T13:14:30.462820Z"), "e1a0dee2-1e31-5f03-8c97-e8d5bcedb9ac"),
    ("l2t_usnjrnl", ("1048576", "281474976727294"), "e9e7f63e-c0a2-53b0-8a13-eb628df6843b"),
    ("l2t_utmpx", ("501", "ttys000", "2020-09-16T13:14:30.462820Z"), "3bbc38ab-8ac0-5aa2-bc78-d4028e4f5795"),
    ("plaso_exec_prefetch", ("SVCHOST.EXE", "892401266", "2009-11-20T09:31:29.671875Z"), "9c9a2690-4727-5eda-94e1-6968d3e8168b"),
    ("plaso_exec_winreg/appcompatcache", ("\\??\\C:\\WINDOWS\\system32\\hkcmd.exe", "2004-02-10T18:31:30.000000Z"), "8968e86e-b445-5d89-b6f0-4ada1121a0ba"),
    ("plaso_fseventsd", ("226530", "/Users/jo/Documents/notes.txt"), "cd7ebdf2-0e7f-554a-8c47-7c7a7975aa8f"),
    ("plaso_pecoff", ("\\Windows\\System32\\evil.dll", "b5de10a000000000000000000000000000000000000000000000000000000000"), "f0b51854-1690-5460-9841-4e17061c24a2"),
]


def events_of(spark, name, *rows):
    records = spark.createDataFrame([(json.dumps(r),) for r in rows], "t string").select(F.try_parse_json("t").alias("record"))
    return maps.apply(records, {name: maps.MAPS[name]}, "desk")


def wrapped(parser="p", **record):
    return {"SourceImage": "i.jsonl", "RecordId": 7, "Parser": parser, "Timestamp": "2024-01-02T03:04:05Z", "Record": record}


def test_pinned_identities(spark):
    rows = []
    for name, values, guid in PINNED:
        entry = identities.ENTRIES[name]
        key = identities.key_of(entry.kind, {k: F.lit(v) for k, v in zip(entry.parts, values, strict=True)})
        rows.append(F.struct(identities.guid_of(key).alias("got"), F.lit(guid).alias("want")))
    assert all(r.got == r.want for r in spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*").collect())
    place = identities.key_of("file", {"SourceImage": F.lit("M57-JO.jsonl"), "RecordId": F.lit("42")})
    assert spark.range(1).select(identities.guid_of(place)).first()[0] == "c2a2034c-66e0-5af6-9576-7f523a541f10"


#: map, record, object, action, fields of the event
CASES = [
    ("plaso_exec_prefetch", wrapped(data_type="windows:prefetch:execution", executable="A.EXE", prefetch_hash=12, username="S-1-5-18"), "process", "create", {"exe": "A.EXE", "user": "SYSTEM"}),
    ("plaso_exec_winreg", wrapped("winreg/AMCACHE", full_path="c:\\x\\e.exe", timestamp_desc="Link Time", file_identifier="0000" + "Ab" * 20), "file", "create", {"file_name": "e.exe", "sha1_hash": "ab" * 20}),
    ("plaso_exec_winreg", wrapped("winreg/amcache", full_path="c:\\x\\e.exe", timestamp_desc="Content Modification Time"), "process", "create", {"exe": "e.exe", "image_path": "c:\\x\\e.exe"}),
    ("plaso_exec_winreg", wrapped("userassist", key_path="k", value_name="UEME_RUNPATH:E:\\R.EXE", display_name="C:\\Users\\Jo\\N.DAT"), "process", "create", {"exe": "R.EXE", "image_path": "E:\\R.EXE", "user": "Jo"}),
    ("plaso_exec_winreg", wrapped("winreg/bam", key_path="k", path="\\Device\\n.exe", user_identifier="S-1-5-21-1"), "process", "create", {"exe": "n.exe", "sid": "S-1-5-21-1"}),
    ("plaso_exec_winreg", wrapped("appcompatcache", path="C:\\w\\h.exe", timestamp_desc="Last Time Executed"), "process", "create", {"exe": "h.exe"}),
    ("plaso_exec_cron", wrapped(data_type="syslog:cron:task_run", command="/bin/run -x", pid=3, username="root", hostname="box"), "process", "create", {"exe": "run", "image_path": "/bin/run", "hostname": "box", "pid": "3"}),
    ("plaso_fseventsd", wrapped(data_type="macos:fseventsd:record", path="/a/n.Txt", event_identifier=5), "file", "modify", {"file_path": "/a/n.Txt", "extension": "txt"}),
    ("plaso_pecoff", wrapped(data_type="pe_coff:file", timestamp_desc="Creation Time", display_name="NTFS:\\w\\e.dll", sha256_hash="AA"), "file", "create", {"file_path": "\\w\\e.dll", "sha256_hash": "aa"}),
    ("plaso_olecf", wrapped(data_type="olecf:summary_info", display_name="NTFS:\\d\\b.xls", author="Jo"), "file", "modify", {"file_name": "b.xls", "owner": "Jo"}),
    ("plaso_registry", wrapped(data_type="windows:registry:run", key_path="HKLM\\Run", display_name="C:\\Users\\Jo\\NTUSER.DAT"), "registry", "key_edit", {"key": "HKLM\\Run", "user": "Jo"}),
    ("plaso_shellitem", wrapped(data_type="windows:shell_item:file_entry", timestamp_desc="Creation Time", shell_item_path="<My Computer> C:\\\\d\\\\f.doc", origin="o.lnk"), "file", "create", {"file_path": "C:\\d\\f.doc", "extension": "doc"}),
    ("l2t_lnk", wrapped(data_type="windows:lnk:link", timestamp_desc="Last Access Time", local_path="C:\\Users\\Jo\\s.exe", display_name="d.lnk", link_target="t"), "file", "read", {"file_name": "s.exe", "user": "Jo", "link_target": "t"}),
    ("l2t_recyclebin", wrapped(data_type="windows:metadata:deleted_item", timestamp_desc="Content Deletion Time", original_filename="C:\\a\\s.xls", display_name="\\$Recycle.Bin\\S-1-5-21-9\\$I1"), "file", "delete", {"file_path": "C:\\a\\s.xls", "uid": "S-1-5-21-9"}),
    ("l2t_srum", wrapped(data_type="windows:srum:network_usage", application="\\Device\\H\\L.exe", user_identifier="S-1-5-18", interface_luid=4, bytes_sent=9), "flow", "message", {"exe": "L.exe", "uid": "S-1-5-18", "out_bytes": "9"}),
    ("l2t_srum", wrapped(data_type="windows:srum:application_usage", application="Diag", user_identifier="x"), "process", "create", {"exe": "Diag"}),
    ("l2t_msiecf", wrapped(data_type="msiecf:url", timestamp_desc="Last Visited Time", url="Visited: Jo@http://a.example:80/x?y", display_name="h.dat"), "http", "get", {"url_domain": "a.example", "url_remainder": "/x?y", "url_scheme": "http"}),
    ("l2t_firefox_cache", wrapped(data_type="firefox:cache:record", request_method="post", url="HTTP:https://b.example/", display_name="h.dat", response_code="HTTP/1.1 204 No"), "http", "post", {"url_full": "https://b.example/", "response_status_code": "204"}),
    ("l2t_firefox_places", wrapped(data_type="chrome:history:page_visited", url="https://c.example/p", display_name="h.dat", from_visit="https://d.example/ (D)", received_bytes=5), "http", "get", {"request_referrer": "https://d.example/", "response_body_bytes": "5"}),
    ("l2t_javaidx", wrapped(data_type="java:download:idx", url="http://e.example/j.jar", display_name="h.dat", ip_address="1.2.3.4"), "http", "get", {"url_remainder": "/j.jar"}),
    ("esedump_srum", {"TableAlias": "NetworkDataUsage", "AppId": 1, "UserId": 2, "InterfaceLuid": 3, "TimeStamp": "2024-01-02T03:04:05Z", "BytesSent": 4, "BytesRecvd": 5, "AppIdName": "\\device\\h\\svc.exe"}, "flow", "message", {"exe": "svc.exe", "in_bytes": "5"}),
    ("esedump_srum", {"TableAlias": "ApplicationResourceUsage", "AppId": 1, "UserId": 2, "TimeStamp": "2024-01-02T03:04:05Z", "UserIdName": "S-1-5-19"}, "process", "create", {"sid": "S-1-5-19"}),
    ("jlecmd_dest", {"Path": "C:\\a\\b.TXT", "SourceFile": "s", "EntryNumber": 3, "Hostname": "pc", "LastModified": "2024-01-02T03:04:05Z"}, "file", "read", {"file_path": "C:\\a\\b.TXT", "extension": "txt", "hostname": "pc"}),
]


@pytest.mark.parametrize(("name", "record", "kind", "action", "fields"), CASES)
def test_one_record_of_each_map(spark, name, record, kind, action, fields):
    rows = events_of(spark, name, record, {"Record": "no object"}, {}).collect()
    assert [(e.car_object, e.car_action) for e in rows] == [(kind, action)]
    event = rows[0]
    assert {k: event.props.get(k) for k in fields} == fields and event.guid and event.source_host
    if "Record" in record:
        assert event.native["spindle_scope"] == "intrinsic"


def test_identities_are_checked(spark):
    whole = events_of(spark, "l2t_mft", wrapped(timestamp_desc="Creation Time", name="/a", file_reference=12), wrapped(timestamp_desc="Creation Time", name="/b"), {"Timestamp": "2024-01-02T03:04:05Z", "Record": {"timestamp_desc": "Creation Time", "name": "/c"}})
    judged = whole.select("guid", F.col("native")["spindle_scope"].alias("scope"), identities.problems(F.col("guid"), F.col("car_object"), F.col("source_artefact"), F.col("native")).alias("p"), identities.equatable(F.col("guid"), F.col("car_object"), F.col("source_artefact"), F.col("native")).alias("e")).collect()
    by_scope = {r.scope: r for r in judged}
    assert by_scope["intrinsic"].p == [] and by_scope["intrinsic"].e
    assert by_scope["positional"].p == [] and not by_scope["positional"].e
    assert by_scope[None].guid is None and not by_scope[None].e
    wrong = whole.where("guid IS NOT NULL").select(identities.problems(F.lit("x"), F.lit("process"), F.col("source_artefact"), F.col("native")).alias("p")).collect()
    assert all({"object", "guid"} <= set(r.p) for r in wrong)
    assert spark.sql("SELECT 'u' AS g, CAST(NULL AS map<string,string>) AS m").select(identities.equatable(F.col("g"), F.lit("flow"), F.lit("zeek_conn"), F.col("m"))).first()[0]


def test_time_and_keys_of_an_identity_are_made_once(spark):
    record = wrapped(display_name="TSK:/d/f.Tar", timestamp_desc="Creation Time")
    events = events_of(spark, "l2t_filestat", record, record | {"Timestamp": "1601-01-01T00:00:00Z"}, record | {"Timestamp": "-", "RecordId": None})
    got = [(r.timestamp, r.native.get("spindle_scope"), r.guid is not None) for r in events.collect()]
    assert got == [("2024-01-02T03:04:05Z", identities.INTRINSIC, True), (None, identities.POSITIONAL, True), (None, None, False)]
    plan = events.select("timestamp", "native")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("1601-01-01") == 1
