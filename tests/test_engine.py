"""Functions, maps, sources, rules and operators of the event engine, on small tables."""

import json
import sqlite3
import uuid

import pytest
from pyspark.sql import functions as F

from evidentia.functions import blanks, ids, markers, times
from evidentia.operators import fold, graph, joins, projection, rules, verify
from evidentia.plans import maps, model
from evidentia.plans.queries import ORACLE, QUERIES
from evidentia.plans.tables import written
from evidentia.sources import jsonl, sqlite


def values(spark, items, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(items)), f"i int, v {kind}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_blanks(spark):
    items = [None, "", "-", " ", "a"]
    assert values(spark, items, blanks.nb) == [None, None, None, " ", "a"]
    assert values(spark, items, blanks.present) == [None, None, "-", " ", "a"]
    assert values(spark, items, blanks.is_missing) == [True, True, False, False, False]
    assert values(spark, items, blanks.is_empty) == [True, True, False, True, False]
    assert values(spark, items, blanks.unidentified) == [True, True, True, True, False]
    assert values(spark, items, blanks.truthy) == [False, False, True, True, True]


def test_times(spark):
    items = ["2024-01-02T03:04:05.1234567Z", "2024-01-02 03:04:05+0200", "2024-01-02T03:04:05", "2024", "2024-13-01T00:00:00", None]
    got = values(spark, items, lambda v: F.date_format(times.parse_ts(v), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert got == ["2024-01-02 03:04:05.123456", "2024-01-02 01:04:05.000000", "2024-01-02 03:04:05.000000", None, None, None]
    assert values(spark, ["1522917168.677", "0", "x", "2024-01-02T03:04:05Z"], lambda v: times.epoch_ts(v, v)) == ["2018-04-05T08:32:48.677000+00:00", "1970-01-01T00:00:00+00:00", None, "2024-01-02T03:04:05Z"]
    assert values(spark, ["/Date(1522917168677)/", "/Date(0+0200)/", "x"], times.dotnet_date) == ["2018-04-05T08:32:48.677000+00:00", "1970-01-01T00:00:00+00:00", None]
    assert values(spark, ["1601-01-01T00:00:00", "2024-01-01T00:00:00"], times.clean_ts) == [None, "2024-01-01T00:00:00"]


def test_fixed_tables(spark):
    """Values that must be as the event model has them, written out here once more."""
    users = ["S-1-0-0", "s-1-5-32-555", "BUILTIN\\Administrators", "nt authority\\ann", "CORP\\SYSTEM", " localsystem ", "systemprofile", "Bob", "S-1-5-21-1", "USERS"]
    assert values(spark, users, markers.user_canon) == ["NULL SID", "REMOTE DESKTOP USERS", "ADMINISTRATORS", "ann", "CORP\\SYSTEM", "SYSTEM", "SYSTEM", "Bob", "S-1-5-21-1", "USERS"]
    want = {("socket", "bind"): "bound to", ("socket", "close"): "terminated", ("thread", "suspend"): "accessed", ("http", "tunnel"): "connected to", ("email", "quarantine"): "locked", ("service", "enumerate"): "listed", ("user_session", "unlock"): "unlocked", ("file", "metadata"): "retrieved information about", ("process", "create"): "accessed"}
    rows = spark.createDataFrame([(*k, v) for k, v in want.items()], "o string, a string, v string")
    assert all(r.v == r.got for r in rows.withColumn("got", graph.verb_of(F.col("o"), F.col("a"))).collect())
    logs = ["evtx_security", "evtx_security_sessions", "evtx_process", "evtx_services", "evtx_sysmon", "evtx_bits", "evtx_rdp", "evtx_more"]
    assert maps.route("20240101_EvtxECmd_Output.json") == maps.route("goevtx.jsonl") == logs
    assert [maps.route(n) for n in ("a.L2tSyslog", "x.L2tUtmpx", "gomft.jsonl", "weird.json", "1_RECmd_Batch_x.json", "Security.json")] == [["plaso_exec_cron", "l2t_text"], ["l2t_utmp"], [], [], ["recmd_batch"], []]


def test_text_markers(spark):
    paths = ["C:\\Windows\\a.EXE", "/usr/bin/.profile", "\\\\srv\\share", "/a/b.tar.gz", "dir/", "-", None]
    assert values(spark, paths, markers.basename) == ["a.EXE", ".profile", None, "b.tar.gz", None, None, None]
    assert values(spark, paths, markers.ext) == ["exe", None, None, "gz", None, None, None]
    assert values(spark, ["u@Ex.com/x", "none", "-"], markers.domain_of) == ["ex.com", None, None]
    assert values(spark, ['"C:\\a b.exe" -x', "C:\\Prog Files\\x.exe /s", "cmd /c y", ""], markers.exe_path) == ["C:\\a b.exe", "C:\\Prog Files\\x.exe", "cmd", None]
    assert values(spark, ["12", "0x1F", "ff", "zz", "-5", "-"], markers.hex_int) == [12, 31, 255, None, -5, None]
    assert values(spark, ["S-1-5-18", "NT AUTHORITY\\SYSTEM", "LocalSystem", "CORP\\ann", "-"], markers.user_canon) == ["SYSTEM", "SYSTEM", "SYSTEM", "CORP\\ann", None]
    assert values(spark, ["a\tb\tc\tx.y\tz\tw", "C:\\p\\q.exe"], markers.win_program_name) == ["x.y_z", "q.exe"]
    assert values(spark, ["a\tb", "C:\\p"], markers.win_program_path) == [None, "C:\\p"]
    assert values(spark, ["k=12", "none"], lambda v: markers.regex1(v, r"k=(\d+)")) == ["12", None]
    assert values(spark, ["GET", "put", "x"], lambda v: markers.map_value(v, {"GET": "get", "PUT": "put"}, upper=True)) == ["get", "put", None]
    assert values(spark, [["a", " b "], ["-"], []], lambda v: markers.at(v, -1), "array<string>") == ["b", None, None]


def test_payload_markers(spark):
    blob = json.dumps({"EventData": {"Data": [{"@Name": "A", "#text": " 1 "}, {"@Name": "A", "#text": "2"}, {"@Name": "B", "#text": "-"}]}})
    assert values(spark, [blob, '{"A": "flat"}', "broken"], lambda v: markers.payload(v, "A")) == ["2", "flat", None]
    assert values(spark, [blob], lambda v: markers.payload(v, "B")) == [None]
    assert values(spark, [json.dumps({"UserData": {"X": {"k": " v "}, "Y": {"k": "w"}}}), "{}"], lambda v: markers.userdata(v, "k")) == ["v", None]


def test_identities(spark):
    space = uuid.uuid5(uuid.NAMESPACE_DNS, "other.example")
    names = ["a", "ü", "", "long " * 50]
    assert values(spark, names, lambda v: ids.uuid5(v, space)) == [str(uuid.uuid5(space, n)) for n in names]
    key = json.dumps({"_obj": "file", "_v": 1, "path": "C:\\x", "when": "t"}, sort_keys=True, separators=(",", ":"))
    made = lambda v: ids.minted("file", 1, {"when": F.lit("t"), "path": v}, {"line": F.lit(7)})
    got = values(spark, ["C:\\x", "-"], made)
    assert got[0] == str(uuid.uuid5(ids.NAMESPACE, key)) and got[1] == str(uuid.uuid5(ids.NAMESPACE, '{"_obj":"file","_v":1,"line":"7"}'))
    assert values(spark, ["x", None, ""], lambda v: ids.fields_guid("flow", v, F.lit(1))) == ["flow-x-1", None, "flow--1"]
    assert values(spark, ["00:1A:2b:3c:4d:5e and 01-00-5e-00-00-fb"], ids.mac_addresses) == [["00:1a:2b:3c:4d:5e"]]
    assert values(spark, ["\\\\?\\Volume{AABBCCDD-0000-1111-2222-333344445555}\\x"], ids.volume_guids) == [["aabbccdd-0000-1111-2222-333344445555"]]
    assert values(spark, ["USBSTOR\\Disk&Ven_X&Prod_Y\\ab12&0"], ids.usb_serials) == [["AB12"]]
    assert values(spark, ["t1059_001 and T1003"], ids.technique_ids) == [["T1059.001", "T1003"]]
    assert values(spark, ["1.2.3.4", "1.2.3.400", "::1", "fe80::1:2", "1:2", "x"], ids.is_ip) == [True, False, True, True, False, False]


def test_scan_and_maps(spark, tmp_path):
    data = {"EventData": {"Data": [{"@Name": k, "#text": v} for k, v in {"ProcessGuid": "{g}", "ProcessId": "77", "Image": "C:\\a.exe", "Hashes": "SHA1=AA,MD5=BB", "User": "NT AUTHORITY\\SYSTEM"}.items()]}}
    create = {"EventId": 1, "Provider": "Microsoft-Windows-Sysmon", "Channel": "x/Sysmon", "Computer": "h.example.org", "EventRecordId": 5, "TimeCreated": "2024-01-01T00:00:00Z", "Payload": json.dumps(data)}
    conn = {"ts": 1522917168.677, "uid": "C1", "id.orig_h": "10.0.0.1", "conn_state": "SF", "orig_pkts": 2, "resp_pkts": 3, "duration": 1.5}
    path = tmp_path / "log.json"
    path.write_bytes(b"\xef\xbb\xbf[\n" + json.dumps(create).encode() + b",\r\n\n" + json.dumps(conn).encode() + b",,\n{broken\n]\n")
    records = jsonl.scan(spark, str(path))
    assert records.count() == 2 and jsonl.rejected(spark, str(path)) == 1
    events = maps.apply(records, {k: maps.MAPS[k] for k in ("evtx_sysmon", "zeek_conn", "zeek_dns")}, "lab")
    process = maps.widened(events, "process").first()
    assert (process.car_action, process.guid, process.source_host, process.md5_hash, process.user, process.fqdn, process.owning_pid) == ("create", "{g}", "h", "bb", "SYSTEM", "h.example.org", "77")
    flow = maps.widened(events, "flow").first()
    assert (flow.car_action, flow.guid, flow.source_host, flow.packet_count, flow.start_time, flow.end_time) == ("end", "C1", "lab", "5", "2018-04-05T08:32:48.677000+00:00", "2018-04-05T08:32:50.177000+00:00")
    assert events.count() == 2 and flow.native["conn_state"] == "SF"
    assert maps.route("abc_conn.json") == ["zeek_conn"] and maps.route("x509.json") == ["zeek_x509"] and maps.route("unknown") == []
    jsonl.write_tree(maps.widened(events, "process"), str(tmp_path / "tree"))
    assert jsonl.read_tree(spark, str(tmp_path / "tree"), "process").first().guid == "{g}"
    assert jsonl.read_tree(spark, str(tmp_path / "tree"), "process").columns == [*model.columns("process"), "car_object"]


def test_container(spark, tmp_path):
    path = tmp_path / "c.l2t"
    path.write_text('{"parser": "winevt/x", "timestamp": 1000001}\n\nbroken\n{"parser": "", "timestamp": 0}\n')
    rows = jsonl.wrap_container(jsonl.numbered(spark, str(path)), "img").orderBy("record_id").collect()
    assert [(r.record_id, r.table, r.timestamp) for r in rows] == [(1, "L2tWinevt", "1970-01-01T00:00:01.000001Z"), (4, "L2tUnknown", None)]


def test_sqlite(spark, tmp_path):
    with sqlite3.connect(tmp_path / "car.db") as db:
        db.executescript("CREATE TABLE process (guid TEXT, pid INT); INSERT INTO process VALUES ('g', 4); CREATE TABLE image_context (x INT); INSERT INTO image_context VALUES (1);")
    sqlite.register(spark)
    rows = spark.read.format("evidence_sqlite").option("path", str(tmp_path / "car.db")).load().collect()
    assert [(r.table_name, json.loads(r.row_json)) for r in rows] == [("process", {"guid": "g", "pid": 4})]


def test_owner_as_of_with_lifetimes(spark):
    creates = spark.createDataFrame([("h", 1, 10, 20, "a", 1), ("h", 1, 30, None, "b", 2), ("h", 2, 5, None, "c", 3), ("h", 2, 8, 9, "d", 4), (None, 3, None, None, "e", 5)], "host string, pid int, t int, e int, guid string, seq int")
    creates = creates.select("host", "pid", F.timestamp_seconds("t").alias("ts"), F.timestamp_seconds("e").alias("exit_ts"), "guid", "seq")
    spokes = spark.createDataFrame([(1, "h", 1, 5), (2, "h", 1, 15), (3, "h", 1, 25), (4, "h", 1, 40), (5, "h", 2, 12), (6, "h", 2, 8), (7, None, 3, 1), (8, None, 3, None), (9, "h", 2, None)], "row_id int, host string, pid int, t int")
    spokes = spokes.select("row_id", "host", "pid", F.timestamp_seconds("t").alias("ts"))
    got = {r.row_id: r.owning_guid for r in joins.owner_as_of(spokes, creates, ["host", "pid"]).collect()}
    assert got == {1: None, 2: "a", 3: None, 4: "b", 5: "c", 6: "d", 7: "e", 8: "e", 9: None}


def test_fold(spark):
    rows = spark.createDataFrame([("h", "g", 1, "", "x", "s1"), ("h", "g", 2, "v", "y", "s2"), (None, "g", 3, "w", "", "s1"), ("h", None, 4, "z", "z", "s1"), ("h", None, 5, "z", "z", "s1")], "source_host string, guid string, seq int, a string, b string, source_artefact string")
    out = sorted(fold.additive(rows, ["source_host", "guid"]).collect(), key=lambda r: r.seq)
    assert [(r.seq, r.a, r.b, r.contributions, r.contributed_by, r.conflicts) for r in out] == [(1, "v", "x", 2, ["s1", "s2"], ["b"]), (3, "w", None, 1, ["s1"], []), (4, "z", "z", 1, ["s1"], []), (5, "z", "z", 1, ["s1"], [])]
    again = fold.additive(fold.additive(rows, ["source_host", "guid"]).select(*rows.columns), ["source_host", "guid"])
    assert again.count() == 4 and again.agg(F.max("contributions")).first()[0] == 1
    best = {r.seq for r in fold.most_populated(rows, ["source_host", "guid"]).collect()}
    assert best == {2, 3, 4, 5}


def test_filters_are_two_valued(spark):
    rows = spark.createDataFrame([(1, "C:\\W\\cmd.exe", "5", {"deep": "yes"}), (2, None, "x", {}), (3, "/bin/CMD.EXE", "50", {"deep": "no"})], "i int, exe string, n string, native map<string,string>")
    resolve = rules.fields_of(rows)
    hit = lambda text: [r.i for r in rows.where(rules.compile_filter(text, resolve)).orderBy("i").collect()]
    assert hit('exe == "cmd.exe"') == [1, 3] and hit("exe != cmd.exe") == [2] and hit("not exe == cmd.exe") == [2]
    assert hit('exe == "*\\\\cmd*"'.replace("\\\\", "\\")) == [1] and hit("n > 9 and (n < 60 or n == x)") == [2, 3] and hit("deep in [yes, maybe]") == [1]
    assert hit('exe match "cmd" or deep == no') == [1, 3] and hit("absent == 1") == []
    for bad in ("exe ==", "(exe == a", "exe ~ a", "exe == a )"):
        with pytest.raises(ValueError):
            rules.compile_filter(bad, resolve)
    assert not rules.runnable("x group by y") and rules.runnable("exe == a")


def test_sigma(spark):
    rows = spark.createDataFrame([(1, "powershell -enc AAA", "a"), (2, "POWERSHELL", None), (3, "bash", "b")], "i int, cmd string, u string")
    resolve = rules.fields_of(rows)
    hit = lambda d: [r.i for r in rows.where(rules.compile_sigma(d, resolve, ["cmd"])).orderBy("i").collect()]
    assert hit({"s": {"cmd|startswith": "powershell"}, "f": {"u": None}, "condition": "s and not f"}) == [1]
    assert hit({"s1": {"cmd|contains|all": ["power", "enc"]}, "s2": {"cmd|endswith": "sh"}, "condition": "1 of s*"}) == [1, 3]
    assert hit({"s": {"cmd|base64": "x"}, "condition": "s"}) == [] and hit({"k": ["bash", "enc"], "condition": "k"}) == [1, 3]
    assert hit({"a": {"cmd|re": "^b.sh"}, "b": {"u": ["a", "b"]}, "condition": "all of them"}) == [3]
    got = rules.hits(rows, {"p": F.col("cmd").contains("p"), "all": F.lit(True)}, ["i"])
    assert got.count() == 4


def test_projection(spark):
    items = ["12", "12.0", "12.5", "true", "x", None]
    assert values(spark, items, projection.to_long) == [12, 12, None, None, None, None]
    assert values(spark, items, projection.to_float) == [12.0, 12.0, 12.5, None, None, None]
    assert values(spark, ["yes", "OFF", "2"], projection.to_boolean) == [True, False, None]
    assert values(spark, ["HKEY_LOCAL_MACHINE\\Software", "x"], projection.hive_short) == ["HKLM\\Software", "x"]
    assert values(spark, ["1.2.3.4", "x"], projection.to_ip) == ["1.2.3.4", None]


def test_graph(spark):
    nodes = spark.createDataFrame([(i,) for i in range(8)], "id long")
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (6, 7)], "a long, b long")
    assert {r.id: r.component for r in graph.components(nodes, links, written).collect()} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 6}
    checks = verify.checked("t", nodes, {"some": (F.col("id") > 3, "ge", 2), "none": (F.col("id") > 3, "eq", 0)}).collect()
    assert [(r.check, r.n, r.passed) for r in checks] == [("some", 4, True), ("none", 4, False)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_have_oracles(name):
    assert name in ORACLE


def test_oracles_agree(spark):
    """A few queries against DuckDB on the smallest tables; the driver compares all of them."""
    duckdb = pytest.importorskip("duckdb")
    sf_dir = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("events", "orders", "customer", "documents", "part", "lineitem", "pages", "labels", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("owner_asof_join", "fold_additive", "spindle_uuid5", "edges_union", "car_rule_hits", "zeek_flows"):
        got = QUERIES[name](spark, sf_dir)
        want = db.sql(ORACLE[name])
        order = sorted(got.columns)
        line = lambda row: tuple(str(x) for x in row)
        assert sorted(map(line, got.select(*order).collect())) == sorted(map(line, want.select(*(duckdb.ColumnExpression(c) for c in order)).fetchall())), name


def test_inner_records_keep_lists_and_numbers(spark):
    rows = [{"SourceImage": "i", "Timestamp": "2024-01-01T00:00:00Z", "Record": {"timestamp_desc": "Last Access Time", "name": "/a/b.Txt", "file_reference": 12, "path_hints": ["x", "y"], "is_allocated": True}}, {"Record": "no object", "Timestamp": "2024-01-01T00:00:00Z"}]
    records = spark.createDataFrame([(json.dumps(r),) for r in rows], "t string").select(F.try_parse_json("t").alias("record"))
    found = maps.apply(records, {"l2t_mft": maps.MAPS["l2t_mft"]}).collect()
    assert len(found) == 1 and found[0].car_action == "read" and found[0].guid is not None
    assert found[0].props == {"file_path": "/a/b.Txt", "file_name": "b.Txt", "extension": "txt"}
    assert found[0].native["file_reference"] == "12" and found[0].native["is_allocated"] == "true" and found[0].native["path_hints"] == '["x","y"]'


def test_values_of_a_record_are_read_once_and_only_where_they_are_told(spark):
    rows = [{"uid": "H1", "trans_depth": 1, "method": "post", "host": "W", "uri": "/p", "resp_fuids": "F1"}, {"uid": "H2", "trans_depth": 1, "method": "CONNECT"}, {"uid": "H3", "method": "HEAD"}]
    records = spark.createDataFrame([(json.dumps(r),) for r in rows], "t string").select(F.try_parse_json("t").alias("record"))
    events = maps.apply(records, {"zeek_http": maps.MAPS["zeek_http"]})
    out = events.select("guid", "car_action", F.try_element_at("props", F.lit("url_full")).alias("url"))
    assert sorted(map(tuple, out.collect())) == [("http-H1-1", "post", "http://W/p"), ("http-H2-1", "tunnel", None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('$["method"]') == 1 and plan.count('$["uid"]') == 1 and "resp_fuids" not in plan
    assert {r.guid: r.native.get("resp_fuids") for r in events.collect()} == {"http-H1-1": "F1", "http-H2-1": None}
