"""Adapters, containers, discovery, the as-of owner join, folds with conflicts, and derived nodes on small cases."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from evidentia.functions import markers
from evidentia.operators import fold, graph, joins
from evidentia.plans import build, derived, links, maps
from evidentia.sources import discover, jsonl

BASE = datetime(2024, 1, 1)


def seconds(n):
    return None if n is None else BASE + timedelta(seconds=n)


@pytest.mark.parametrize("seed", [1, 2])
def test_owners_equal_brute_force_with_a_hot_key_and_nested_lifetimes(spark, seed):
    rng = random.Random(seed)
    key = lambda: 7 if rng.random() < 0.8 else rng.choice([None, 1, 2, 3])
    creates, spokes, by = [], [], {}
    for i in range(3000):
        at = rng.choice([None] + [rng.randint(0, 5000)] * 30)
        end = None if rng.random() < 0.3 else (at or 0) + rng.choice([0, 1, 5, 50, 500, -3])
        k = key()
        creates.append((k, seconds(at), seconds(end), f"g{i}", i))
        by.setdefault(k, []).append((seconds(at) or datetime.min, i, f"g{i}", seconds(end)))
    for i in range(4000):
        spokes.append((i, rng.choice([key(), 99]), seconds(rng.choice([None] + [rng.randint(0, 5200)] * 40))))
    made = spark.createDataFrame(creates, "pid int, ts timestamp, exit_ts timestamp, guid string, seq int")
    got = {r.row_id: r.owning_guid for r in joins.owner_as_of(spark.createDataFrame(spokes, "row_id int, pid int, ts timestamp"), made, ["pid"]).collect()}
    want = {}
    for i, k, t in spokes:
        own = sorted(by.get(k, []))
        alive = [c for c in own if t is not None and c[0] <= t and (c[3] is None or c[3] >= t)]
        want[i] = alive[-1][2] if alive else own[0][2] if t is None and len(own) == 1 else None
    assert got == want


def test_lifetimes_are_never_broadcast_and_only_asked_where_one_may_hold(spark, monkeypatch):
    spans = spark.createDataFrame([(1, 0, 900, "a"), (1, 5, 8, "b")], "pid int, start long, end long, guid string")
    points = spark.createDataFrame([(1, 1, 7), (2, 1, 9), (3, 1, 901)], "row_id int, pid int, at long")
    met = joins.innermost(points, spans, ["pid"], "at", "start", "end", F.col("guid"), F.struct("start"))
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
    assert {r.row_id: r.taken for r in met.collect()} == {1: "b", 2: "a"}
    # every earlier lifetime has ended as well: no spoke is compared with stretches
    made = spark.createDataFrame([(1, seconds(10 * k), seconds(10 * k + 5), f"g{k}", k) for k in range(5)], "pid int, ts timestamp, exit_ts timestamp, guid string, seq int")
    spokes = spark.createDataFrame([(k, 1, seconds(k)) for k in range(60)], "row_id int, pid int, ts timestamp")
    asked = []
    monkeypatch.setattr(joins, "innermost", lambda *rest: asked.append(rest))
    got = {r.row_id: r.owning_guid for r in joins.owner_as_of(spokes, made, ["pid"]).collect()}
    assert got == {k: f"g{k // 10}" if k < 50 and k % 10 <= 5 else None for k in range(60)} and not asked


def test_lines_are_numbered_over_splits_with_every_kind_of_line_end(spark, tmp_path):
    lines = [json.dumps({"n": k, "pad": "x" * 200}) for k in range(3000)]
    lines[10], lines[20], lines[21] = "", "  ", "broken"
    (tmp_path / "c.jsonl").write_bytes(("\n".join(lines[:1000]) + "\r\n" + "\r".join(lines[1000:2000]) + "\n" + "\r\n".join(lines[2000:])).encode() + b"\n\xff\xfe{}")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        found = jsonl.numbered(spark, str(tmp_path / "c.jsonl"))
        got = {r.record_id: r.line for r in found.collect()}
        assert spark.read.text(str(tmp_path / "c.jsonl")).rdd.getNumPartitions() > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k + 1: x for k, x in enumerate(lines) if x.strip()} | {3001: "\ufffd\ufffd{}"}


def records(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "v string").select(F.try_parse_json("v").alias("record"))


def test_event_log_rows_of_a_timeline_are_named_by_their_layout(spark):
    xml = "<Channel>Security</Channel><Computer>pc.x.org</Computer>"
    rows = [
        {"Timestamp": "2024-01-01T00:00:00Z", "Record": {"event_identifier": 4634, "xml_string": xml, "strings": ["S-1-5-21-9", "bob", "DOM", "0x5"], "record_number": 7}},
        {"Timestamp": "t", "Record": {"event_identifier": 59.0, "source_name": "Microsoft-Windows-Bits-Client", "strings": ["i", "n", "x", "https://d.example/f"], "hostname": "h", "record_number": 8}},
        {"Timestamp": "t", "Record": {"event_identifier": 25, "source_name": "Kernel-Boot", "strings": ["a"]}},
        {"Timestamp": "t", "Record": {"event_identifier": "4634", "xml_string": xml, "strings": ["a"]}},
        {"Timestamp": "t", "Record": {"event_identifier": 4634, "xml_string": xml}},
        {"Timestamp": "t"},
    ]
    events = {r.guid: r for r in maps.mapped(records(spark, rows), ["l2t_winevt"]).collect()}
    assert set(events) == {"user_session-pc.x.org-Security-7", "http-h-Microsoft-Windows-Bits-Client-8", None}
    gone = events["user_session-pc.x.org-Security-7"]
    assert (gone.car_action, gone.props["user"], gone.props["login_id"], gone.source_host) == ("logout", "bob", "0x5", "pc")
    assert events["http-h-Microsoft-Windows-Bits-Client-8"].props["url_domain"] == "d.example"


def test_jump_lists_give_a_record_for_each_entry(spark):
    lists = [
        {"SourceFile": "f", "AppId": {"AppId": "a1", "Description": "app"}, "DestListEntries": [{"Path": "C:\\a.txt", "LastModified": "/Date(1522187139502)/", "EntryNumber": 3}, 5, {"Path": "C:\\b.txt", "LastModified": "kept", "EntryNumber": 4}]},
        {"AppId": {}, "DestListEntries": []}, {"SourceFile": "g"},
    ]
    rows = maps.mapped(records(spark, lists), ["jlecmd_dest"]).orderBy("guid").collect()
    assert [(r.guid, r.timestamp, r.native["AppDescription"]) for r in rows] == [("file-f-3", "2018-03-27T21:45:39.502000+00:00", "app"), ("file-f-4", "kept", "app")]


def test_files_are_found_and_routed_by_name_else_by_folder(spark, tmp_path):
    for name in ("s1/gore/asset.jsonl", "s1/x_EvtxECmd_Output.json", "s2/deep/er/conn.json", "s2/image.jsonl", "s2/gowxt/raw.jsonl", "s2/notes.txt", "loose.jsonl", "s2/.hidden/conn.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("{}")
    found = [(s, p.rsplit("/", 1)[1]) for s, p, _ in discover.files(spark, str(tmp_path))]
    assert sorted(found) == [("s1", "asset.jsonl"), ("s1", "x_EvtxECmd_Output.json"), ("s2", "conn.json"), ("s2", "image.jsonl")]
    assert maps.route("a/gore/asset.jsonl") == ["recmd_batch"] and maps.route("asset.jsonl") == [] and maps.known("a/gowxt/raw.jsonl")


def test_containers_are_split_into_tables_and_mapped(spark, tmp_path):
    rows = [{"data_type": "fs:stat", "parser": "filestat", "timestamp": 1700000000000000 + k, "display_name": f"TSK:/a/{k}.txt", "timestamp_desc": "Creation Time"} for k in range(50)]
    rows += [{"data_type": "windows:evtx:record", "parser": "winevtx", "timestamp": 1700000000000000, "event_identifier": 4634, "source_name": "Security", "strings": ["S", "bob"], "record_number": 1, "hostname": "h"}, {"data_type": "x", "parser": "unheard/of"}, {"Record": {}}]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "image.jsonl").write_text("\n".join(map(json.dumps, rows)))
    events = build.parse(spark, discover.files(spark, str(tmp_path)))
    count = {r["car_object"]: r["count"] for r in events.groupBy("car_object").count().collect()}
    assert count == {"file": 50, "user_session": 1}
    assert {r.p for r in events.where("car_object = 'file'").select(F.get_json_object(links.native("spindle_ref"), "$.RecordId").alias("p")).collect()} == {str(k) for k in range(1, 51)}


MODEL = "source string, source_host string, car_object string, car_action string, guid string, timestamp string, source_artefact string, owning_pid string, owning_guid_native string, parent_pid string, props map<string,string>, native map<string,string>, row_id string"


def model(spark, rows):
    names = [c.split()[0] for c in MODEL.split(", ")]
    full = [tuple({"source": "s", "source_artefact": "a", "props": {}, "native": {}, "row_id": f"{k:04}"}.get(n) if n not in r else r[n] for n in names) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, MODEL).withColumn("ts", F.col("timestamp").cast("timestamp"))


def test_a_fold_keeps_what_others_say_otherwise(spark):
    one = {"car_object": "file", "guid": "g", "timestamp": "2024-01-01"}
    rows = model(spark, [one | {"props": {"a": "1"}, "native": {"spindle_ref": "r0"}}, one | {"props": {"a": "2", "b": ""}, "source_artefact": "z"}, one | {"props": {"a": "2", "b": "3"}, "native": {"n": "x"}, "source_artefact": "z"}, {"car_object": "file"}, {"car_object": "file"}, one | {"guid": "h"}]).drop("ts")
    out = fold.merged(rows, ["source", "source_host", "car_object", "guid"], ["timestamp", "row_id"]).collect()
    assert len(out) == 4
    whole = next(r for r in out if r.guid == "g")
    assert whole.props == {"a": "1", "b": "3"} and whole.native["n"] == "x" and whole.native["contributions"] == "3" and whole.native["spindle_ref"] == "r0"
    assert json.loads(whole.native["coalesced_conflicts"]) == {"a": [{"source_artefact": "z", "value": "2"}]} and json.loads(whole.native["coalesced_sources"]) == ["a", "z"]
    assert json.loads(whole.native["contributed_by"])[0] == {"source_artefact": "a", "spindle_ref": "r0"}
    assert next(r for r in out if r.guid == "h").native == {}


def test_memory_offsets_and_sessions_that_nothing_observed_are_inferred(spark):
    rows = model(spark, [
        {"car_object": "module", "car_action": "load", "guid": "m1", "timestamp": "2024-01-01", "owning_pid": "4", "source_host": "h"},
        {"car_object": "module", "car_action": "load", "guid": "m2", "timestamp": "2024-01-02", "owning_pid": "5", "source_host": "h"},
        {"car_object": "authentication", "car_action": "success", "guid": "a", "timestamp": "2024-01-03", "native": {"TargetLogonId": "0xAB"}, "props": {"target_user": "bob"}, "source_host": "h"},
        {"car_object": "authentication", "car_action": "success", "guid": "b", "timestamp": "2024-01-03", "native": {"TargetLogonId": "0x3e7"}, "source_host": "h"},
    ])
    rows = links.with_facts(rows, links.stages(rows)).withColumn("owning_offset", F.when(F.col("car_object") == "module", F.lit("255")))
    nodes = {r.node_id: r for r in derived.inferred_nodes(rows).collect()}
    assert set(nodes) == {"proc-ff", "user_session-0xab"}
    process = nodes["proc-ff"]
    assert process.corroborated_by == ["m1", "m2"] and process.properties == {"pid": "4"} and json.loads(process.conflicts) == {"pid": ["5"]}
    assert process.reason == "owning_process_memory: referenced by 2 observed record(s) via offset; no process event observed (reconstructed, not evidence)"
    assert nodes["user_session-0xab"].properties == {"login_id": "0xAB", "user": "bob"}
    told = {(r.relationship, r.source_guid, r.target_guid, r.inferred_end) for r in derived.relations(rows).collect()}
    assert told == {("loaded", "proc-ff", "m1", "source"), ("loaded", "proc-ff", "m2", "source"), ("created", "a", "user_session-0xab", "target")}


def test_an_inferred_node_lists_all_that_it_rests_on(spark):
    base = {"car_object": "module", "car_action": "load", "source_host": "h"}
    rows = model(spark, [base | {"guid": f"m{k:03}", "timestamp": f"2024-01-01T00:{k // 60:02}:{k % 60:02}", "owning_pid": str(k + 10)} for k in range(150)])
    rows = links.with_facts(rows, links.stages(rows)).withColumn("owning_offset", F.lit("255"))
    (node,) = derived.inferred_nodes(rows).collect()
    assert node.corroborated_by == [f"m{k:03}" for k in range(150)]
    assert node.properties == {"pid": "10"} and json.loads(node.conflicts) == {"pid": [str(k + 10) for k in range(1, 150)]}


def test_lists_of_values_are_bounded_and_first_seen(spark):
    said = spark.range(5000).select(F.lit("k").alias("k"), F.lit("p").alias("property"), (F.col("id") % 1000).cast("string").alias("value"), F.col("id").alias("at"))
    (row,) = graph.first_values(said, ["k"], "property", "value", "at", 64).collect()
    assert row["values"] == {"p": [str(i) for i in range(64)]}


def test_member_sets_count_once_at_their_best_tier(spark):
    rows = spark.createDataFrame([(1, "a", "x", "n"), (2, "b", "x", "n"), (3, "a", "y", "n2"), (4, "a", "y", "n2"), (5, "b", None, "n3"), (6, "a", "", "n3")], "row int, source string, h string, n string")
    got = {(r.tier, r.join_key, r.row, r.source) for r in graph.member_sets(rows, [("content", F.col("h")), ("name", F.col("n"))], "row", "source").collect()}
    assert got == {("content", "x", 1, "a"), ("content", "x", 2, "b"), ("name", "n3", 5, "b"), ("name", "n3", 6, "a")}


def test_integers_are_read_as_a_scripting_language_would(spark):
    def integer(text):
        for base in (10, 16):
            try:
                return n if -(1 << 63) <= (n := int(text, base)) < 1 << 63 else None
            except ValueError:
                pass
        return None

    texts = ["12", "-12", "+7", "0x1FC", "0X1fc", "ff", "-0xff", "-ff", "1_000", "0x_1f", "1__0", "_1", "7fffffffffffffff", "0x7FFFFFFFFFFFFFFF", "ffffffffffffffff", "000000000000000000ff", "9223372036854775807", "0", "-0x0", "x", "0x", " 5 ", "1.5", "12 3", "deadbeefdeadbeef1"]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(markers.hex_int(F.col("t")).alias("n")).collect()]
    assert got == [integer(t) for t in texts]


def test_values_of_a_payload_are_put_together_once(spark):
    blob = '{"EventData": {"Data": [{"@Name": "a", "#text": " 1 "}, {"@Name": "a", "#text": "2"}, {"@Name": "b", "#text": "-"}]}, "a": "9", "c": "3"}'
    rows = spark.createDataFrame([(blob,), ('{"c": "4"}',), (None,)], "p string").select(*(v.alias(k) for k, v in markers.parsed(F.col("p")).items()))
    out = rows.select(markers.cleaned({c: F.col(c) for c in markers.PARSED.values()})[markers.CLEANED["values"]].alias("v"))
    assert [r.v for r in out.collect()] == [{"a": "2", "c": "3"}, {"c": "4"}, {}]
    # its text has the making of the bag once, however often the values are read
    assert out._jdf.queryExecution().analyzed().toString().count("map_from_entries") == 1
