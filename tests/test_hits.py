"""Readers of detection tools' hits."""

import json

import pytest

from evidentia.sources import hits

ENVELOPE = {"DetectionId": " d1 ", "Title": "", "Severity": "HIGH", "AttackIds": ["T1059.001", "t1003"], "Source": "zeek", "Timestamp": "2024-01-01T00:00:00Z", "Entity": "10.0.0.1 -> 10.0.0.2:445", "Details": {"Computer": "h1", "proto": "TCP"}}
FOUND = {"rule.id": "r1", "rule": {"name": "Rule"}, "threat": {"technique": {"id": ["T1047", "T1047"]}}, "source": {"ip": ["10.0.0.9"]}, "destination.ip": "10.0.0.8", "destination": {"port": 80}, "@timestamp": "2024-01-02T00:00:00.5Z", "file": {"hash": {"md5": "aa"}}, "event.id": "g1"}
ALERT = {"kibana.alert.rule": {"rule_id": "k1", "threat": [{"technique": [{"id": "T1003", "subtechnique": [{"id": "T1003.001"}]}]}]}, "host": {"name": "h2"}}


def read(spark, folder, name, text):
    (folder / name).write_text(text)
    docs, bad = hits.read_documents(spark, [str(folder / name)])
    return {r.detection_id: r for r in hits.hits(docs).collect()}, sum(r.lines for r in bad.collect())


def test_four_shapes_of_documents_give_the_same_hits(spark, tmp_path):
    every = [ENVELOPE, FOUND, ALERT, {"message": "no detection"}]
    response = {"hits": {"hits": [{"_index": "i", "_id": str(k), "_source": d} for k, d in enumerate(every)]}}
    shapes = {
        "lines": "\n".join(map(json.dumps, every)) + "\n\n", "list": json.dumps(every), "pretty": json.dumps(every, indent=2), "response": json.dumps(response), "pretty-response": json.dumps(response, indent=1),
        "bad": "{no json\n" + "\n".join(map(json.dumps, every)),
    }
    for name, text in shapes.items():
        got, bad = read(spark, tmp_path, name, text)
        assert set(got) == {"d1", "r1", "k1"} and bad == (name == "bad"), name
        d, r, k = got["d1"], got["r1"], got["k1"]
        assert (d.title, d.severity, d.attack_ids, d.source_ip, d.destination_ip, d.destination_port, d.host, d.transport) == ("d1", "high", ["T1059.001", "T1003"], "10.0.0.1", "10.0.0.2", 445, "h1", "tcp")
        assert (r.title, r.attack_ids, r.entity, r.at, r.hashes, r.guid) == ("Rule", ["T1047"], "10.0.0.9 -> 10.0.0.8:80", "2024-01-02T00:00:00.500Z", {"MD5": "aa"}, "g1") and r.source == ("i" if "response" in name else None)
        assert (k.attack_ids, k.entity, k.title) == (["T1003", "T1003.001"], "h2", "k1")
    got, bad = read(spark, tmp_path, "one", json.dumps(ENVELOPE, indent=2))
    assert set(got) == {"d1"} and bad == 0
    assert read(spark, tmp_path, "empty", "\n \n") == ({}, 0)


def test_bundles_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="bundle"):
        read(spark, tmp_path, "bundle", json.dumps({"type": "bundle", "objects": []}))


def test_lanes_of_tools(spark, tmp_path):
    lines = {
        "suricata": [{"event_type": "alert", "timestamp": "2024-01-01T00:00:00+00:00", "src_ip": "10.0.0.1", "dest_ip": "x", "alert": {"signature": "S", "metadata": {"mitre_technique_id": ["T1046"]}}}, {"event_type": "flow"}],
        "hayabusa": [{"RuleTitle": "R", "Timestamp": "2024-01-01 00:00:00Z", "Computer": "h", "MitreTags": "", "OtherTags": "T1003 ¦ x", "Details": {"PGUID": "g", "PID": "0x10", "Proc": "p.exe"}}, {"Details": "text"}],
        "yara": [{"tool": "yara", "rule": "T1055_inject", "pid": 7, "host": "h"}, {"tool": "yara"}, {"tool": "other", "rule": "x"}],
    }
    got = {}
    for lane, rows in lines.items():
        (tmp_path / lane).write_text("\n".join(map(json.dumps, rows)))
        got[lane] = hits.lane_hits(hits.read_documents(spark, [str(tmp_path / lane)])[0], lane).collect()
    assert [(r.name, r.attack_ids, r.ips) for r in got["suricata"]] == [("S", ["T1046"], ["10.0.0.1"])]
    assert [(r.name, r.attack_ids, r.process_guid, r.pid, r.process) for r in got["hayabusa"]] == [("R", ["T1003"], "g", 16, "p.exe"), ("Hayabusa detection", [], None, None, None)]
    assert [(r.name, r.pid, r.host) for r in got["yara"]] == [("T1055_inject", 7, "h")]


def test_a_field_of_a_document_is_read_once(spark):
    docs = spark.createDataFrame([(json.dumps(FOUND),), (json.dumps(ENVELOPE),)], "t string").selectExpr("'p' AS path", "CAST(NULL AS string) AS index", "try_parse_json(t) AS doc")
    out = hits.hits(docs).select("at", "source_ip", "destination_port")
    assert sorted(map(tuple, out.collect())) == [("2024-01-01T00:00:00.000Z", "10.0.0.1", 445), ("2024-01-02T00:00:00.500Z", "10.0.0.9", 80)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('$["@timestamp"][0]') == 1 and plan.count('$["source"]["ip"][0]') == 1
