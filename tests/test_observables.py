"""Observables of a small case: values, accounts put together, contents of files."""

import uuid

from pyspark.sql import functions as F

from evidentia.operators import fold
from evidentia.plans import observables
from tests.test_links import model


def test_documents_are_filled_in_order_and_keep_what_differs(spark):
    rows = [("d", "name", "b", False, 2), ("d", "name", "a", False, 1), ("d", "name", "", False, 0), ("d", "name", None, False, 0), ("d", "tags", "y", True, 3), ("d", "tags", "x", True, 4), ("d", "tags", "y", True, 5), ("e", "name", "a", False, 1)]
    got = {r.id: r for r in fold.documents(spark.createDataFrame(rows, "id string, field string, value string, listed boolean, at int"), "id", "field", "value", "at").collect()}
    assert got["d"].fields == {"name": ["a"], "tags": ["y", "x"]} and got["d"].conflicts == {"name": ["b"]}
    assert got["e"].fields == {"name": ["a"]} and got["e"].conflicts == {}
    many = spark.range(500).select(F.lit("d").alias("id"), F.lit("f").alias("field"), F.col("id").cast("string").alias("value"), F.lit(True).alias("listed"), F.col("id").alias("at"))
    assert len(fold.documents(many, "id", "field", "value", "at").first().fields["f"]) == fold.LISTED


def test_values_have_the_standard_identities(spark):
    rows = model(spark, [
        {"car_object": "flow", "guid": "1", "timestamp": "2024-01-01", "props": {"src_ip": "1.2.3.4", "dest_ip": "::1", "dest_fqdn": "a.example"}}, {"car_object": "flow", "guid": "2", "timestamp": "2024-01-02", "props": {"dest_ip": "1.2.3.4", "src_ip": "localhost"}},
    ])
    got = {r.value: r for r in observables.value_observables(rows).collect()}
    assert set(got) == {"1.2.3.4", "::1", "a.example"} and got["1.2.3.4"].roles == ["dest_ip", "src_ip"] and got["1.2.3.4"].observations == 2
    for value, kind in (("1.2.3.4", "ipv4-addr"), ("::1", "ipv6-addr"), ("a.example", "domain-name")):
        assert got[value].id == f"{kind}--{uuid.uuid5(observables.STANDARD, f'{{"value":"{value}"}}')}"


def test_accounts_are_the_case_s_unless_they_are_real(spark):
    rows = model(spark, [
        {"car_object": "process", "guid": "1", "timestamp": "2024-01-01", "props": {"sid": "S-1-5-21-1-2-3-4", "user": "bob"}, "source_host": "h"}, {"car_object": "process", "guid": "2", "timestamp": "2024-01-02", "props": {"uid": "S-1-5-21-1-2-3-4", "user": "robert"}, "source_host": "i"},
        {"car_object": "process", "guid": "3", "timestamp": "2024-01-01", "props": {"user": "bob"}, "source_host": "h"}, {"car_object": "process", "guid": "4", "timestamp": "2024-01-01", "props": {"user": "bob"}, "source_host": "i"}, {"car_object": "process", "guid": "5", "props": {"sid": "S-1-5-18"}},
    ])
    got = observables.accounts(rows, "case").collect()
    assert len({r.id for r in got}) == len(got) == 4
    real = next(r for r in got if r.fields.get("user_id") == ["S-1-5-21-1-2-3-4"])
    assert real.fields["display_name"] == ["bob"] and real.conflicts == {"display_name": ["robert"]} and "x_source_host" not in real.fields
    assert sorted(r.fields["x_source_host"][0] for r in got if "account_login" in r.fields) == ["h", "i"]


def test_hashes_that_events_share_are_one_file(spark):
    md5, sha1, sha256, other = "a" * 32, "b" * 40, "c" * 64, "d" * 64
    event = lambda guid, **props: {"car_object": "file", "guid": guid, "timestamp": "2024-01-01", "props": props}
    rows = model(spark, [event("1", md5_hash=md5.upper(), sha1_hash=sha1), event("2", sha1_hash=sha1, sha256_hash=sha256), event("3", sha256_hash=other), event("4", sha256_hash="no hash"), {"car_object": "file", "props": {"md5_hash": md5}}])
    files, nodes = observables.content_files(rows)
    got = {r.id: r.hashes for r in files.collect()}
    whole = f"file--{uuid.uuid5(observables.STANDARD, f'{{"hashes":{{"MD5":"{md5}"}}}}')}"
    assert got[whole] == {"md5": md5, "sha1": sha1, "sha256": sha256} and len(got) == 2 and {"sha256": other} in got.values()
    assert {r.node_id: r.id for r in nodes.collect()}[f"sha256:{sha256}"] == whole
    assert observables.content_files(rows.where("false"))[0].count() == 0
