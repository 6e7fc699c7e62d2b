"""Objects of the exchange standard of a small case."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.plans import build, exchange, observables
from tests.test_links import model

MD5, SHA = "a" * 32, "c" * 64
SID = "S-1-5-21-1-2-3-4"


def scoped(kind, *parts):
    space = uuid.uuid5(ids.NAMESPACE, "case|c")
    return f"{kind}--{uuid.uuid5(space, '|'.join([kind, *parts]))}"


def worldwide(kind, **contributing):
    return f"{kind}--{uuid.uuid5(observables.STANDARD, json.dumps(contributing, separators=(',', ':')))}"


def event(kind, guid, action="create", at="2024-01-01T00:00:00", owner=None, parent=None, native=None, host="h", **props):
    return {"car_object": kind, "car_action": action, "guid": guid, "timestamp": at, "props": props, "native": native or {}, "source_host": host, "_owner": owner, "_parent": parent}


def rows_of(spark, events):
    links = spark.createDataFrame([(f"{k:04}", e["_owner"], e["_parent"], None) for k, e in enumerate(events)], "row_id string, owner_guid string, parent_guid string, link_confidence string")
    return model(spark, events).join(links, "row_id")


EVENTS = [
    event("process", "p1", pid="0x10", image_path="C:\\bin\\a.exe", exe="a.exe", md5_hash=MD5.upper(), sid=SID, user="bob", ppid="4", parent_exe="up.exe", env_vars="E=1", integrity_level="High"),
    event("process", "p2", at="2024-01-01T00:00:01", parent="p1", pid="zz", ppid="16", command_line="b --x", parent_image_path="C:\\bin\\a.exe", user="carol", integrity_level="odd"),
    event("file", "f1", at="2024-01-01T00:00:02", file_path="C:\\data\\x.txt", sha256_hash=SHA, pid="16", mime_type="text/plain") | {"_owner": "p1"},
    event("file", "f2", "write", at="2024-01-01T00:00:03", file_path="C:\\data\\x.txt", mime_type="text/html", md5_hash="no", pid="77"),
    event("flow", "n1", at="2024-01-01T00:00:04", src_ip="10.0.0.1", dest_ip="FE80::1", src_port="80", dest_port="x", transport_protocol="TCP", end_time="2024-01-01T00:00:09", uid="C1") | {"_owner": "p1"},
    event("registry", "r1", at="2024-01-01T00:00:05", key="HKLM\\A", value="v", data="1", type="reg_sz", user="bob"),
    event("registry", "r2", at="2024-01-01T00:00:06", key="HKLM\\A", value="w", type="odd"),
    event("authentication", "a1", "success", at="2024-01-01T00:00:07", target_uid=SID.lower().replace("s-", "S-"), target_user="robert", app_name="x"),
    event("http", "w1", "get", at="2024-01-01T00:00:08", url_full="https://a.example/q", url_domain="a.example", url_scheme="HTTPS", response_status_code="200", user_agent_full="ua"),
    event("service", "s1", at="2024-01-01T00:00:08", name="svc", image_path="/sbin/x"),
    event("thread", "t1", "remote_create", at="2024-01-01T00:00:08", tgt_pid="5", start_module="C:\\m.dll"),
    event("email", "m1", "deliver", at="2024-01-01T00:00:08") | {"props": {"from": "c@x.example", "to": "a@x.example; b@x.example,", "subject": "s", "attachment_name": "z.zip", "attachment_size": "12"}},
    event("socket", "k1", "listen", at="2024-01-01T00:00:08", local_address="0.0.0.0", local_port="443", family="af_inet", protocol="TCP"),
    event("user_session", "u1", "login", at="2024-01-01T00:00:08"),
    event("module", None, "load", module_path="C:\\m.dll", signer="S"),
    event("driver", "d1", "load", at=None, module_name="d.sys"),
    event("nothing", "x"),
]


@pytest.fixture(scope="module")
def ready(spark):
    rows = rows_of(spark, EVENTS)
    files, contents = observables.content_files(rows)
    return files, exchange.prepared(rows, contents)


@pytest.fixture(scope="module")
def documents(ready):
    files, made = ready
    return {r.id: json.loads(r.document) for r in exchange.object_documents(exchange.objects(made, "c", files)).collect()}


@pytest.fixture(scope="module")
def observed(ready):
    return {r.guid: r for r in exchange.observations(ready[1], "c").collect()}


def test_processes_are_put_together_from_all_that_name_them(documents):
    p1, p2 = documents[scoped("process", "h", "p1")], documents[scoped("process", "h", "p2")]
    assert p1["pid"] == 16 and p1["extensions"] == {"windows-process-ext": {"integrity_level": "high"}} and p1["x_parent"] == {"pid": 4, "exe": "up.exe"} and p1["x_entity_id"] == "p1"
    assert p1["creator_user_ref"] == worldwide("user-account", user_id=SID) and p1["created_time"] == "2024-01-01T00:00:00.000Z"
    assert p2["parent_ref"] == p1["id"] and "pid" not in p2 and "extensions" not in p2 and p2["creator_user_ref"] == scoped("user-account", "h", "name", "carol")
    image = documents[p1["image_ref"]]
    assert image["id"] == scoped("file", "h", "path", "C:\\bin\\a.exe") and image["name"] == "a.exe" and image["hashes"] == {"MD5": MD5} and image["x_content_ref"] == worldwide("file", hashes={"MD5": MD5})
    assert documents[image["parent_directory_ref"]]["path"] == "C:\\bin" and documents[image["x_content_ref"]] == {"type": "file", "spec_version": "2.1", "id": image["x_content_ref"], "hashes": {"MD5": MD5}}
    account = documents[worldwide("user-account", user_id=SID)]
    assert account["display_name"] == "bob" and account["x_conflicts"] == {"display_name": ["robert"]} and "x_source_host" not in account


def test_each_object_gives_its_things(documents):
    x = documents[scoped("file", "h", "path", "C:\\data\\x.txt")]
    assert x["mime_type"] == "text/plain" and x["x_conflicts"] == {"mime_type": ["text/html"]} and x["hashes"] == {"SHA-256": SHA} and x["name"] == "x.txt"
    flow = documents[scoped("network-traffic", "h", "flow", "n1")]
    assert flow["src_ref"] == worldwide("ipv4-addr", value="10.0.0.1") and flow["dst_ref"] == worldwide("ipv6-addr", value="fe80::1") and flow["protocols"] == ["tcp"] and flow["src_port"] == 80 and flow["is_active"] is False and "dst_port" not in flow
    key = documents[scoped("windows-registry-key", "h", "key", "HKLM\\A")]
    assert key["values"] == [{"name": "v", "data": "1", "data_type": "REG_SZ"}, {"name": "w"}]
    web = documents[scoped("network-traffic", "h", "http", "w1")]
    assert web["protocols"] == ["tcp", "https"] and web["x_url_ref"] == worldwide("url", value="https://a.example/q") and web["dst_ref"] == worldwide("domain-name", value="a.example")
    assert web["extensions"]["http-request-ext"] == {"request_method": "get", "request_value": "https://a.example/q", "request_header": {"User-Agent": "ua", "Host": "a.example"}}
    mail = documents[scoped("email-message", "h", "m1")]
    assert mail["to_refs"] == [worldwide("email-addr", value="a@x.example"), worldwide("email-addr", value="b@x.example")] and mail["is_multipart"] is False and documents[mail["x_attachment_ref"]]["size"] == 12
    sock = documents[scoped("network-traffic", "h", "socket", "k1")]
    assert sock["extensions"] == {"socket-ext": {"address_family": "AF_INET", "is_listening": True}} and sock["protocols"] == ["tcp"]
    assert documents[scoped("process", "h", "service", "svc")]["extensions"]["windows-service-ext"] == {"service_name": "svc"}
    assert documents[documents[scoped("x-thread", "h", "t1")]["start_module_ref"]]["x_signer"] == "S"
    assert documents[scoped("x-record", "h", "user_session", "u1")]["x_object"] == "user_session"
    assert len([d for d in documents.values() if d["type"] == "x-record"]) == 1
    for d in documents.values():
        for k, v in d.items():
            for ref in ([v] if k.endswith("_ref") else v if k.endswith("_refs") else []):
                assert ref in documents, (d["type"], k)


def test_observations_keep_what_no_thing_has(observed, documents):
    assert set(observed) == {e["guid"] for e in EVENTS if e["guid"] and e["timestamp"] and e["car_object"] != "nothing"}
    p1, p2, f1 = observed["p1"], observed["p2"], observed["f1"]
    assert p1.fields == {"env_vars": "E=1"} and p2.fields == {"pid": "zz", "integrity_level": "odd"} and p1.process_entity_id == "p1"
    content = worldwide("file", hashes={"SHA-256": SHA})
    assert f1.roles[content] == ["sha256_hash"] and f1.roles[scoped("process", "h", "p1")] == ["owning_guid"] and f1.fields == {} and f1.process_entity_id == "p1"
    assert observed["f2"].fields == {"md5_hash": "no", "pid": "77"}
    assert observed["n1"].fields == {"dest_port": "x", "uid": "C1"} and observed["r2"].fields == {"type": "odd"} and observed["a1"].fields == {"app_name": "x"}
    assert observed["u1"].object_refs == [scoped("x-record", "h", "user_session", "u1")]
    assert {r for o in observed.values() for r in o.object_refs} <= set(documents)


def relation(verb, start, end, inferred=None, **more):
    base = {"timestamp": None, "source": "s", "source_host": "h", "relationship": verb, "source_object": start[0], "source_guid": start[1], "target_object": end[0], "target_guid": end[1], "confidence": "definitive", "method": "m", "class": "declared"}
    return base | {"identity_key": None, "inferred_end": inferred, "corroborated_by": None, "properties": None} | more


EDGES = "timestamp timestamp, source string, source_host string, relationship string, source_object string, source_guid string, target_object string, target_guid string, confidence string, method string, class string, identity_key string, inferred_end string, corroborated_by array<string>, properties string"


def test_relations_end_on_objects_or_are_told_apart(spark, ready, observed, documents):
    edges = [
        relation("Created", ("process", "p1"), ("file", "f1")), relation("created", ("process", "p1"), ("process", "p2")), relation("created", ("process", "p1"), ("process", "p2")),
        relation("requested", ("process", "p1"), ("authentication", "a1")), relation("attempted to authenticate", ("user_account", f"sid:{SID}"), ("file", "f1")), relation("accessed", ("process", "gone"), ("file", "f1")),
        relation("??", ("process", "p1"), ("file", "f1")), relation("created", ("process", "p9"), ("file", "f1"), "source", **{"class": "derived"}), relation("created", ("process", "p1"), ("driver", "d1")),
    ]
    links = spark.createDataFrame([tuple(e[c.split()[0]] for c in EDGES.split(", ")) for e in edges], EDGES)
    made = exchange.observations(ready[1], "c")
    related = exchange.relationships(links, exchange.ends(ready[1], made, "c"), "c")
    got = {(r.relationship_type, r.source_ref, r.target_ref): r for r in related.collect()}
    p1, p2, x = scoped("process", "h", "p1"), scoped("process", "h", "p2"), scoped("file", "h", "path", "C:\\data\\x.txt")
    node = scoped("x-inferred-node", "h", "p9")
    assert set(got) == {
        ("created", p1, x), ("created", p1, p2), ("requested", p1, observed["a1"].id), ("attempted-to-authenticate", worldwide("user-account", user_id=SID), x), ("accessed", None, x), ("created", node, x), ("created", p1, scoped("file", "h", "name", "d.sys")),
    }
    assert got["created", p1, x].level == 100
    nodes = spark.createDataFrame([], "source string, source_host string, node_id string, object string, identity_key string, identity_value string, reason string, method string, corroborated_by array<string>, properties map<string,string>, conflicts string, first_seen timestamp, last_seen timestamp")
    alone = exchange.inferred(nodes, related, "c").collect()
    assert [(r.id, r.object, r.node_id) for r in alone] == [(node, "process", "p9")]
    pairs = {(r.id, r.source_ref, r.target_ref): r.relationships for r in exchange.connected(made, related).collect()}
    want = {}
    for o in observed.values():
        for r in got.values():
            if r.source_ref in o.object_refs and r.target_ref in o.object_refs:
                want[o.id, r.source_ref, r.target_ref] = want.get((o.id, r.source_ref, r.target_ref), 0) + 1
    assert pairs == want and len(want) >= 2
    hits = spark.createDataFrame([("R1", "x", "s", "h", "file", "f1", "2024-01-01T00:00:02"), ("R1", "x", "s", None, "file", "f0", None)], "rule_id string, clause string, source string, source_host string, car_object string, guid string, timestamp string")
    seen = {r.guid: r for r in exchange.sightings(hits, made, "c").collect()}
    assert seen["f1"].observed_data_refs == [observed["f1"].id] and seen["f0"].observed_data_refs == [] and seen["f0"].where_sighted_ref is None
    whole = exchange.bundle(rows_of(spark, EVENTS), links, nodes, "c", hits)
    out = [json.loads(d) for (d,) in whole.select("document").collect()]
    assert len({d["id"] for d in out}) == len(out) == len(documents) + len(observed) + 6 + 1 + 2
    assert next(d for d in out if d["id"] == observed["f1"].id)["x_connected"][0]["relationships"] == 1


def test_an_empty_case_has_no_objects(spark):
    rows = rows_of(spark, EVENTS[:1]).where(F.lit(False))
    made = exchange.prepared(rows)
    assert exchange.objects(made, "c").count() == 0 and exchange.observations(made, "c").count() == 0


def test_pairs_of_an_observation_are_shuffled_once_and_short(spark):
    uuid = "00000000-0000-5000-8000-00000000000"
    a, b, c, odd = f"ipv4-addr--{uuid}1", f"domain-name--{uuid}1", f"file--{uuid}2", "file--A-1"
    observed = spark.createDataFrame([("o1", [c, a, None, b, odd]), ("o2", [b, c]), ("o3", None)], "id string, object_refs array<string>")
    related = spark.createDataFrame([(a, c), (c, a), (a, c), (b, c), (a, b), (odd, a), (a, None), (a, a)], "source_ref string, target_ref string")
    met = exchange.connected(observed, related)
    assert {tuple(r) for r in met.collect()} == {("o1", a, c, 2), ("o1", c, a, 1), ("o1", b, c, 1), ("o1", a, b, 1), ("o1", odd, a, 1), ("o2", b, c, 1)}
    assert met.count() == 6
    # one row for each two things, whatever the direction, and half as many bytes as the text of an identity
    texts = [a, b, c, odd, "file--A1", "file--a-1", f"\x00file--{uuid}2"]
    short = [bytes(r[0]) for r in spark.createDataFrame([(x,) for x in texts], "x string").select(exchange.short(F.col("x"))).collect()]
    assert len(set(short)) == len(texts) and [len(x) for x in short[:3]] == [25, 27, 20]


def test_references_need_no_properties_and_only_the_objects_that_there_are(spark, ready, observed):
    rows = rows_of(spark, EVENTS)
    kinds = exchange.event_objects(rows)
    assert kinds == sorted({e["car_object"] for e in EVENTS} - {"nothing"})
    light = exchange.prepared(rows, observables.content_files(rows)[1], kinds, properties=False)
    assert "told" not in light.select(F.explode("things").alias("t")).select("t.*").columns
    made = exchange.observations(light, "c")
    assert {r.guid: r.object_refs for r in made.collect()} == {r.guid: r.object_refs for r in observed.values()}
    ends = lambda of: {tuple(r) for r in exchange.ends(of, made, "c").collect()}
    assert ends(light) == ends(ready[1])
    owned = rows.where("car_object = 'file'")
    assert {tuple(r) for r in build.edges(owned, ["file"]).collect()} == {tuple(r) for r in build.edges(owned).collect()}
