"""The build path end to end on a small case of two sources."""

import json

from pyspark.sql import functions as F

from evidentia.plans import build


def windows(number, provider, at, record, **data):
    body = {"EventData": {"Data": [{"@Name": k, "#text": v} for k, v in data.items()]}}
    return {"EventId": number, "Provider": provider, "Channel": "x/Sysmon", "Computer": "pc.example.org", "EventRecordId": record, "TimeCreated": at, "Payload": json.dumps(body)}


def test_build(spark, tmp_path):
    sysmon = [
        windows(1, "Microsoft-Windows-Sysmon", "2024-01-01T00:00:00Z", 1, ProcessGuid="{p}", ProcessId="10", Image="C:\\p.exe", CommandLine="p", User="NT AUTHORITY\\SYSTEM"),
        windows(1, "Microsoft-Windows-Sysmon", "2024-01-01T00:00:10Z", 2, ProcessGuid="{c}", ProcessId="11", Image="C:\\c.exe", CommandLine="c -x", ParentProcessGuid="{p}", ParentProcessId="10"),
        windows(11, "Microsoft-Windows-Sysmon", "2024-01-01T00:00:20Z", 3, ProcessGuid="{c}", ProcessId="11", TargetFilename="C:\\x.txt"),
        windows(13, "Microsoft-Windows-Sysmon", "2024-01-01T00:00:30Z", 4, ProcessId="11", TargetObject="HKLM\\a\\v", Details="1"),
        windows(5, "Microsoft-Windows-Sysmon", "2024-01-01T00:00:40Z", 5, ProcessGuid="{c}", ProcessId="11", Image="C:\\c.exe"),
        windows(13, "Microsoft-Windows-Sysmon", "2024-01-01T00:00:50Z", 6, ProcessId="11", TargetObject="HKLM\\a\\w", Details="1"),
    ]
    five = {"id.orig_h": "10.0.0.5", "id.resp_h": "1.2.3.4", "uid": "C1", "ts": 1704067200.5}
    capture = {"conn": [five | {"conn_state": "SF", "proto": "tcp"}], "dns": [five | {"uid": "C0", "trans_id": 7, "query": "name.example", "answers": ["1.2.3.4", "alias"]}], "http": [five | {"trans_depth": 1, "method": "GET", "host": "name.example", "uri": "/a"}]}
    files = []
    for source, name, rows in [("pc", "pc_EvtxECmd_Output.json", sysmon + sysmon[:1]), *(("net", f"{k}.json", v) for k, v in capture.items())]:
        (tmp_path / source).mkdir(exist_ok=True)
        (tmp_path / source / name).write_text("\n".join(map(json.dumps, rows)))
        files.append((source, str(tmp_path / source / name), None))
    build.build(spark, files, str(tmp_path / "out"))
    events, edges = spark.read.parquet(str(tmp_path / "out/events")), spark.read.parquet(str(tmp_path / "out/edges"))
    assert events.count() == 9  # the repeated record is folded
    rows = {(r.car_object, r.car_action, r.timestamp[17:19]): r for r in events.collect()}
    child = rows["process", "create", "10"]
    assert child.props["parent_exe"] == "C:\\p.exe" and child.parent_guid == "{p}"
    made = rows["file", "create", "20"]
    assert (made.owner_guid, made.link_confidence) == ("{c}", "definitive") and made.props["image_path"] == "C:\\c.exe"
    assert (rows["registry", "value_edit", "30"].owner_guid, rows["registry", "value_edit", "30"].link_confidence) == ("{c}", "heuristic")
    assert rows["registry", "value_edit", "50"].owner_guid is None  # its process had ended
    flow = events.where("car_object = 'flow' AND car_action = 'end'").first()
    assert flow.props["dest_fqdn"] == "name.example"
    http = events.where("car_object = 'http'").first()
    assert http.flow_guid == "C1" and http.props["url_full"] == "http://name.example/a"
    told = {(r.relationship, r.source_guid, r.target_object) for r in edges.collect()}
    assert {("created", "{p}", "process"), ("created", "{c}", "file"), ("modified", "{c}", "registry"), ("contained", "C1", "http")} <= told
    line = build.timeline(events, edges, after="2024-01-01 00:00:05").collect()
    assert [r.ts for r in line] == sorted(r.ts for r in line) and {r.kind for r in line} == {"object", "relationship"}
    assert build.timeline(events, edges, host="pc").where(F.col("host") != "pc").count() == 0
