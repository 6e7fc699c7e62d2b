"""Hits of detection tools: documents of several shapes by one schema-less scan, and their fields as one schema."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions.blanks import present
from evidentia.functions.markers import hex_int
from evidentia.functions.times import iso_z, parse_ts

#: Hash fields of documents; details of an envelope that name the host and the protocols; the fields of an envelope; the files of lanes of tools.
HASH_NAMES = {"MD5": "file.hash.md5", "SHA-1": "file.hash.sha1", "SHA-256": "file.hash.sha256", "SHA-512": "file.hash.sha512"}
HOST_DETAILS = ["Computer", "host.name", "Hostname", "HostName", "image_hostname"]
TRANSPORT_DETAILS = ["network.transport", "proto", "Proto", "transport"]
PROTOCOL_DETAILS = ["network.protocol", "app_proto", "service", "Protocol"]
ENVELOPE = ["DetectionId", "Title", "Severity", "AttackIds", "Source", "Timestamp", "DetectedAt", "RunId", "Entity", "Details"]
LANES = {"suricata": ["eve.json", ".eve.jsonl"], "hayabusa": ["timeline.jsonl"], "yara": ["yara.jsonl", "scan.jsonl", "memory.jsonl", "disk.jsonl", "matches.jsonl"]}


# -- documents --------------------------------------------------------------------------------------------------------------


def paths(name: str) -> list[str]:
    """Where a dotted name can be: each of its dots is nesting, or part of a name."""
    first, *rest = name.split(".")
    out = []
    for nesting in product((True, False), repeat=len(rest)):
        steps = [first]
        for apart, part in zip(nesting, rest, strict=True):
            steps[-1:] = [steps[-1], part] if apart else [f"{steps[-1]}.{part}"]
        out.append("$" + "".join(f'["{s}"]' for s in steps))
    return out


def at(doc: Column, name: str, kind: str = "string") -> Column:
    """A field by its dotted name; of a list its first element."""
    return F.coalesce(*(F.try_variant_get(doc, p, kind) for path in paths(name) for p in (f"{path}[0]", path)))


def whole(doc: Column, name: str) -> Column:
    """A field as JSON text."""
    return F.coalesce(*(F.try_variant_get(doc, p, "string") for p in paths(name)))


def documents_of(parsed: DataFrame) -> DataFrame:
    """(path, doc): of each parsed text its documents: the elements of a list, what a search response found, or the text's own."""
    found = F.try_variant_get("value", "$.hits.hits", "array<variant>")
    items = F.try_variant_get("value", "$", "array<variant>")
    search = F.coalesce(F.schema_of_variant(F.try_variant_get("value", "$.hits.hits", "variant")).startswith("ARRAY"), F.lit(False))
    listed = F.schema_of_variant("value").startswith("ARRAY")
    each = F.when(search, F.transform(found, lambda h: F.struct(F.try_variant_get(h, "$._source", "variant").alias("doc"), F.try_variant_get(h, "$._index", "string").alias("index"))))
    none = F.lit(None).cast("string")
    each = each.otherwise(F.transform(F.when(listed, items).otherwise(F.array("value")), lambda d: F.struct(d.alias("doc"), none.alias("index"))))
    out = parsed.select("path", F.explode(each).alias("d")).select("path", "d.doc", "d.index")
    return out.where(F.schema_of_variant("doc").startswith("OBJECT"))


def parsed(lines: DataFrame) -> DataFrame:
    return lines.select("path", "text", F.try_parse_json("text").alias("value"))


def is_bundle(value: Column) -> Column:
    kind = F.try_variant_get(value, "$.type", "string")
    return F.coalesce((kind == "bundle") & F.try_variant_get(value, "$.objects", "variant").isNotNull(), F.lit(False))


def read_documents(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(documents, unparseable) of files that are JSON lines, one document, a list of them or a search response.

    A file whose first line is a whole JSON text is read by lines, split as Spark splits it, whatever its size. Only others are
    read whole: texts over several lines; those that are none even then are lines with a bad first one. Bundles of the exchange
    standard are refused. ``unparseable`` counts the bad lines of each file.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.monotonically_increasing_id().alias("n")).where(F.trim("text") != "")
    start = lines.groupBy("path").agg(F.min_by("text", "n").alias("text"))
    odd = [r.path for r in start.where(F.try_parse_json("text").isNull()).select("path").collect()]
    by_line, together = lines.select("path", "text"), None
    if odd:
        read = parsed(spark.read.text(odd, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
        together = read.where("value IS NOT NULL")
        by_line = by_line.join(together.select("path"), "path", "left_anti")
    by_line = parsed(by_line)
    every = by_line if together is None else by_line.unionByName(together)
    refused = every.where(is_bundle(F.col("value"))).select("path").limit(1).collect()
    if refused:
        raise ValueError(f"{refused[0].path} is a bundle of the exchange standard, not a file of hits")
    return documents_of(every.where("value IS NOT NULL")), by_line.where("value IS NULL").groupBy("path").agg(F.count("*").alias("lines"))


# -- hits -------------------------------------------------------------------------------------------------------------------


def moment(text: Column) -> Column:
    return iso_z(parse_ts(text))


def ip(text: Column) -> Column:
    return F.when(ids.is_ip(F.trim(text)), F.trim(text))


def port(text: Column) -> Column:
    return F.when(hex_int(text).between(0, 65535), hex_int(text))


def hits(docs: DataFrame) -> DataFrame:
    """One row for each document that names a detection, of the envelope's shape or the search engine's; others give none.

    An envelope has DetectionId and its fields beside it; its entity may be ``address -> address:port``. A document of the search
    engine names its rule by any of four fields.
    """
    doc, fields, values = F.col("doc"), {}, {}

    def kept(made: dict[str, Column], column: Column) -> Column:
        """A column that is made once, in a projection of its own: those that follow read it several times."""
        name = f"_{'f' if made is fields else 'v'}{len(made)}"
        made[name] = column
        return F.col(name)

    field = lambda *names: F.coalesce(*(present(kept(fields, at(doc, n))) for n in names))
    told = {n: kept(fields, present(F.try_variant_get(doc, f"$.{n}", "string"))) for n in ENVELOPE}
    e = lambda name: told[name]
    wrapped = kept(fields, F.coalesce(F.try_variant_get(doc, "$.DetectionId", "variant").isNotNull(), F.lit(False)))
    entity = e("Entity")
    arrow = lambda n: kept(values, present(F.regexp_extract(entity, r"^\s*(\S+)\s*->\s*(\S+)\s*$", n)))
    left, right = arrow(1), arrow(2)
    inner = kept(values, F.coalesce(F.try_parse_json(e("Details")), F.to_variant_object(F.struct(e("Details").alias("value")))))
    # an address that ends the entity whole has no port
    start, end = ip(left), F.coalesce(ip(right), ip(F.regexp_extract(right, r"^\[?(.*?)\]?:\d+$", 1)))
    both = start.isNotNull() & end.isNotNull()
    number = F.when(ip(right).isNull(), F.regexp_extract(right, r":(\d+)$", 1).try_cast("bigint"))
    detail = lambda *names: F.coalesce(*(present(F.try_variant_get(inner, f'$["{n}"]', "string")) for n in names))
    envelope = {
        "detection_id": F.trim(e("DetectionId")), "title": F.coalesce(e("Title"), F.trim(e("DetectionId"))), "severity": F.lower(e("Severity")), "attack_ids": ids.technique_ids(F.coalesce(e("AttackIds"), F.lit(""))), "source": e("Source"), "at": moment(e("Timestamp")),
        "detected_at": moment(e("DetectedAt")), "run_id": e("RunId"), "entity": entity, "host": detail(*HOST_DETAILS), "source_ip": F.when(both, start), "destination_ip": F.when(both, end), "destination_port": F.when(both, number),
        "transport": F.lower(detail(*TRANSPORT_DETAILS)), "protocol": F.lower(detail(*PROTOCOL_DETAILS)), "file_name": F.lit(None).cast("string"), "guid": F.lit(None).cast("string"), "hashes": F.lit(None).cast("map<string,string>"),
    }
    named = F.trim(field("detection.id", "rule.id", "kibana.alert.rule.rule_id", "signal.rule.id"))
    techniques = F.concat(ids.technique_ids(F.coalesce(whole(doc, "threat.technique.id"), F.lit(""))), ids.technique_ids(F.coalesce(whole(doc, "kibana.alert.rule.threat"), F.lit(""))))
    host, event, file = field("host.name", "host.hostname"), field("event.id"), field("file.name", "file.path")
    source, target, number = kept(values, ip(field("source.ip"))), kept(values, ip(field("destination.ip"))), kept(values, port(field("destination.port")))
    way = F.concat(source, F.lit(" -> "), target, F.coalesce(F.concat(F.lit(":"), number), F.lit("")))
    known = F.map_filter(F.create_map(*(x for label, name in HASH_NAMES.items() for x in (F.lit(label), at(doc, name)))), lambda k, v: v.isNotNull())
    searched = {
        "detection_id": named, "title": F.coalesce(field("rule.name", "kibana.alert.rule.name"), named), "severity": F.lower(field("detection.severity", "kibana.alert.severity", "event.severity")), "attack_ids": F.array_distinct(techniques),
        "source": F.coalesce(field("detection.source_index"), F.col("index"), field("_index", "event.dataset")), "at": moment(field("kibana.alert.original_time", "@timestamp")),
        "detected_at": moment(field("detection.detected_at", "kibana.alert.last_detected", "kibana.alert.start")), "run_id": field("detection.run_id", "kibana.alert.rule.execution.uuid"),
        "entity": F.coalesce(host, way, file, field("process.name"), event), "host": host, "source_ip": source, "destination_ip": target, "destination_port": number,
        "transport": F.lower(field("network.transport")), "protocol": F.lower(field("network.protocol")), "file_name": file, "guid": event, "hashes": known,
    }
    read = docs.select("*", *(v.alias(k) for k, v in fields.items())).withColumns(values)
    out = read.select("path", *(F.when(wrapped, envelope[c]).otherwise(v).alias(c) for c, v in searched.items()))
    return out.where("detection_id <> ''")


def lane_hits(docs: DataFrame, lane: str) -> DataFrame:
    """Hits of a detection tool's own lines: (lane, name, attack_ids, at, host, ips, process_guid, pid, process)."""
    doc = F.col("doc")
    g = lambda path: present(F.try_variant_get(doc, path, "string"))
    found = lambda *paths: F.coalesce(*(F.when(F.size(t) > 0, t) for t in (ids.technique_ids(F.coalesce(g(p), F.lit(""))) for p in paths)), F.array().cast("array<string>"))
    none = F.lit(None).cast("string")
    number = lambda path: hex_int(g(path))
    told = {
        "suricata": (g("$.event_type") == "alert", F.coalesce(g("$.alert.signature"), F.lit("Suricata IDS alert")), found("$.alert.metadata.mitre_technique_id", "$.alert.metadata"), g("$.timestamp"), none, F.array_compact(F.array(ip(g("$.src_ip")), ip(g("$.dest_ip")))), none, number("$.pid"), none),
        "hayabusa": (F.lit(True), F.coalesce(g("$.RuleTitle"), F.lit("Hayabusa detection")), found("$.MitreTags", "$.OtherTags"), g("$.Timestamp"), g("$.Computer"), F.array().cast("array<string>"), F.coalesce(g("$.Details.PGUID"), g("$.Details.ProcessGuid"), g("$.ExtraFieldInfo.ProcessGuid")), number("$.Details.PID"), g("$.Details.Proc")),
        "yara": ((g("$.tool") == "yara") & g("$.rule").isNotNull(), g("$.rule"), found("$.rule"), none, g("$.host"), F.array().cast("array<string>"), none, number("$.pid"), g("$.process")),
    }
    test, name, techniques, when, host, ips, guid, pid, process = told[lane]
    return docs.where(test).select("path", F.lit(lane).alias("lane"), name.alias("name"), techniques.alias("attack_ids"), moment(when).alias("at"), host.alias("host"), ips.alias("ips"), guid.alias("process_guid"), pid.alias("pid"), process.alias("process"))
