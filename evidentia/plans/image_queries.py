"""Maps of disk images' rows, and their identities, as queries over the orders: a row of a kind for each order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import identities
from evidentia.plans import maps
from evidentia.plans.queries import query, table


def path() -> Column:
    return F.concat(F.lit("/d/f"), F.col("k"), F.lit(".Doc"))


def wrapped(spark: SparkSession, sf_dir: str, kinds: list[Mapping[str, Column]], plain: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows with a record each, of the kind that the order's number tells; `Parser` goes beside the inner record."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"))
    turn = F.col("k") % len(kinds)
    names = sorted({n for kind in kinds for n in kind})
    pick = lambda n: F.coalesce(*(F.when(turn == i, kind[n].cast("string")) for i, kind in enumerate(kinds) if n in kind))
    outer = {"SourceImage": F.lit("i"), "RecordId": F.col("k"), "Timestamp": F.col("t"), "Parser": pick("Parser") if "Parser" in names else F.lit("p")} | dict(plain or {})
    record = F.struct(*(v.alias(n) for n, v in outer.items()), F.struct(*(pick(n).alias(n) for n in names if n != "Parser")).alias("Record"))
    return o.select("k", F.try_parse_json(F.to_json(record)).alias("record"))


def told(rows: DataFrame, names: list[str], what: list[str], detail: list[str]) -> DataFrame:
    prop = lambda keys: F.coalesce(*(F.try_element_at("props", F.lit(k)) for k in keys))
    events = maps.apply(rows, {n: maps.MAPS[n] for n in names})
    return events.select("k", F.col("car_object").alias("object"), F.col("car_action").alias("action"), prop(what).alias("what"), prop(detail).alias("detail"), "guid", F.try_element_at("native", F.lit(identities.SCOPE)).alias("scope"))


def minted_sql(kinds: list[str]) -> str:
    """SQL of kinds in turn; each selects object, action, what, detail, the identity's key, or a plain guid, from r."""
    rows = " UNION ALL ".join(f"SELECT k, {sql.replace(' WHERE ', f' FROM r WHERE k % {len(kinds)} = {i} AND ') if ' WHERE ' in sql else f'{sql} FROM r WHERE k % {len(kinds)} = {i}'}" for i, sql in enumerate(kinds))
    return f"""WITH r AS (SELECT o_orderkey AS k, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS t, '/d/f' || o_orderkey || '.Doc' AS p FROM orders),
    e(k, object, action, what, detail, key) AS ({rows}), h AS (SELECT *, sha1(unhex('{identities.SPACE.hex}') || encode(key)) AS h FROM e)
    SELECT k, object, action, what, detail, CASE WHEN key LIKE '{{%' THEN h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', h[17:17]), 1) || h[18:20] || '-' || h[21:32] ELSE key END AS guid,
    CASE WHEN key LIKE '{{"Rec%' THEN 'positional' WHEN key LIKE '{{%' THEN 'intrinsic' END AS scope FROM h"""


def key_sql(kind: str, **parts: str) -> str:
    """SQL of a key; the parts are named in the order of the alphabet."""
    return f"""'{{"_obj":"{kind}","_v":1""" + "".join(f""","{n}":"' || {v} || '\"""" for n, v in parts.items()) + "}'"


@query(minted_sql([
    f"""'process', 'create', 'P' || c || '.EXE', NULL, {key_sql("process", exe="'P' || c || '.EXE'", prefetch_hash="k", run_time="t")}""",
    """'file', 'create', 'f' || k || '.Doc', p, '{"RecordId":"' || k || '","SourceImage":"i","_obj":"file","_v":1}'""",
    f"""'process', 'create', 'f' || k || '.Doc', p, {key_sql("process", image_path="p", recorded_time="t")}""",
    f"""'process', 'create', 'r' || k || '.exe', 'E:/r' || k || '.exe', {key_sql("process", event_time="t", key_path="'kp'", value_name="'UEME_RUNPATH:E:/r' || k || '.exe'")} WHERE c % 2 = 0""",
    f"""'process', 'create', 'f' || k || '.Doc', p, {key_sql("process", event_time="t", image_path="p", key_path="'kp'")}""",
    f"""'process', 'create', 'f' || k || '.Doc', p, {key_sql("process", image_path="p", recorded_time="t")}""",
    f"""'process', 'create', 'c' || c, '/bin/c' || c, {key_sql("process", command="'/bin/c' || c || ' -x'", event_time="t", pid="k")}""",
]))
def image_execution_map(spark, sf_dir):
    """Traces of programs in an image: prefetch files, four registry caches, scheduled tasks."""
    k, c = F.col("k"), F.col("c")
    kinds = [
        {"data_type": F.lit("windows:prefetch:execution"), "executable": F.concat(F.lit("P"), c, F.lit(".EXE")), "prefetch_hash": k},
        {"Parser": F.lit("winreg/amcache"), "timestamp_desc": F.lit("Link Time"), "full_path": path()},
        {"Parser": F.lit("winreg/AMCACHE"), "timestamp_desc": F.lit("Creation Time"), "full_path": path()},
        {"Parser": F.lit("winreg/userassist"), "key_path": F.lit("kp"), "value_name": F.when(c % 2 == 0, F.concat(F.lit("UEME_RUNPATH:E:/r"), k, F.lit(".exe"))).otherwise("UEME_CTLSESSION")},
        {"Parser": F.lit("winreg/bam"), "key_path": F.lit("kp"), "path": path()},
        {"Parser": F.lit("winreg/appcompatcache"), "path": path(), "timestamp_desc": F.lit("Last Time Executed")},
        {"data_type": F.lit("syslog:cron:task_run"), "command": F.concat(F.lit("/bin/c"), c, F.lit(" -x")), "pid": k},
    ]
    return told(wrapped(spark, sf_dir, kinds), ["plaso_exec_prefetch", "plaso_exec_winreg", "plaso_exec_cron"], ["exe", "file_name"], ["image_path", "file_path"])


@query(minted_sql([
    f"""'file', CASE c % 4 WHEN 0 THEN 'create' WHEN 1 THEN 'modify' ELSE 'read' END, 'f' || k || '.Doc', 'doc', {key_sql("file", event_time="t", file_path="p", lnk_file="'d.lnk'")} WHERE c % 4 < 3""",
    f"""'file', 'delete', 'f' || k || '.Doc', 'doc', {key_sql("file", artefact_file="'x'", event_time="t", file_path="p")}""",
    f"""'file', 'create', 'f' || k || '.Doc', 'doc', {key_sql("file", event_time="t", file_path="p", origin="'o'")}""",
    f"""'file', 'create', 'f' || k || '.Doc', 'doc', {key_sql("file", file_path="p", sha256="'ab' || k")}""",
    f"""'file', CASE WHEN c % 2 = 0 THEN 'create' ELSE 'modify' END, 'f' || k || '.Doc', 'doc', {key_sql("file", event_time="t", file_path="p")}""",
    f"""'file', 'modify', 'f' || k || '.Doc', 'doc', {key_sql("file", event_identifier="k", file_path="p")}""",
    f"""'registry', 'key_edit', 'HK/' || k, 'u' || c, {key_sql("registry", hive="'/Users/u' || c || '/N.DAT'", key_path="'HK/' || k", last_write="t")}""",
]))
def image_files_map(spark, sf_dir):
    """Traces of files and registry keys in an image: links, recycle bins, shell items, programs, documents, volume events."""
    k, c = F.col("k"), F.col("c")
    moment = F.element_at(F.array(*(F.lit(x) for x in ("Creation Time", "Content Modification Time", "Last Access Time", "Added Time"))), (c % 4 + 1).cast("int"))
    kinds = [
        {"data_type": F.lit("windows:lnk:link"), "timestamp_desc": moment, "local_path": path(), "display_name": F.lit("d.lnk")},
        {"data_type": F.lit("windows:metadata:deleted_item"), "timestamp_desc": F.lit("Content Deletion Time"), "original_filename": path(), "display_name": F.lit("x")},
        {"data_type": F.lit("windows:shell_item:file_entry"), "timestamp_desc": F.lit("Creation Time"), "shell_item_path": F.concat(F.lit("<My Computer> "), path()), "origin": F.lit("o")},
        {"data_type": F.lit("pe_coff:file"), "timestamp_desc": moment, "display_name": F.concat(F.lit("NTFS:"), path()), "sha256_hash": F.concat(F.lit("AB"), k)},
        {"data_type": F.lit("olecf:summary_info"), "timestamp_desc": F.when(c % 2 == 0, "Creation Time"), "display_name": path()},
        {"data_type": F.lit("macos:fseventsd:record"), "path": path(), "event_identifier": k},
        {"data_type": F.lit("windows:registry:run"), "key_path": F.concat(F.lit("HK/"), k), "display_name": F.concat(F.lit("/Users/u"), c, F.lit("/N.DAT"))},
    ]
    return told(wrapped(spark, sf_dir, kinds), ["l2t_lnk", "l2t_recyclebin", "plaso_shellitem", "plaso_pecoff", "plaso_olecf", "plaso_fseventsd", "plaso_registry"], ["file_name", "key"], ["extension", "user"])


@query(minted_sql([
    f"""'http', 'get', 'a' || c || '.example', '/x' || k, {key_sql("http", db_path="'h.dat'", url="'http://a' || c || '.example:80/x' || k", visit_time="t")}""",
    f"""'http', CASE c % 3 WHEN 0 THEN 'get' ELSE 'post' END, 'b.example', '/' || k, {key_sql("http", db_path="'h.dat'", url="'https://b.example/' || k", visit_time="t")} WHERE c % 3 < 2""",
    f"""'http', 'get', 'c.example', '/' || k, {key_sql("http", db_path="'h.dat'", url="'http://c.example/' || k", visit_time="t")}""",
    f"""'http', 'get', 'd.example', '/' || k, {key_sql("http", db_path="'h.dat'", url="'http://d.example/' || k", visit_time="t")}""",
    f"""'flow', 'message', 's' || c, 'S-1-5-' || c, {key_sql("flow", application="'s' || c", interface_luid="k", recorded_time="t", user_identifier="'S-1-5-' || c")}""",
    f"""'process', 'create', 's' || c, NULL, {key_sql("process", application="'s' || c", recorded_time="t", user_identifier="'x'")}""",
]))
def image_web_and_usage_map(spark, sf_dir):
    """Visits and resource usage in an image: four browsers' stores, programs by network and by processor."""
    k, c = F.col("k"), F.col("c")
    at = lambda prefix: F.concat(F.lit(prefix), k)
    service, store = F.concat(F.lit("s"), c), {"display_name": F.lit("h.dat")}
    kinds = [
        {"data_type": F.lit("msiecf:url"), "timestamp_desc": F.lit("Last Visited Time"), "url": F.concat(F.lit("Visited: Jo@http://a"), c, F.lit(".example:80/x"), k), **store},
        {"data_type": F.lit("firefox:cache:record"), "request_method": F.element_at(F.array(F.lit("GET"), F.lit("post"), F.lit("HEAD")), (c % 3 + 1).cast("int")), "url": at("HTTP:https://b.example/"), **store},
        {"data_type": F.lit("chrome:history:page_visited"), "url": at("http://c.example/"), **store},
        {"data_type": F.lit("java:download:idx"), "url": at("http://d.example/"), **store},
        {"data_type": F.lit("windows:srum:network_usage"), "application": service, "user_identifier": F.concat(F.lit("S-1-5-"), c), "interface_luid": k},
        {"data_type": F.lit("windows:srum:application_usage"), "application": service, "user_identifier": F.lit("x")},
    ]
    return told(wrapped(spark, sf_dir, kinds), ["l2t_msiecf", "l2t_firefox_cache", "l2t_firefox_places", "l2t_javaidx", "l2t_srum"], ["url_domain", "exe"], ["url_remainder", "uid", "sid"])


@query("""SELECT o_orderkey AS k, 'flow' AS object, 'svc' || o_custkey || '.exe' AS what, 'flow-1-' || o_custkey || '-3-' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '-4-' || o_orderkey AS guid FROM orders WHERE o_custkey % 2 = 0
    UNION ALL SELECT o_orderkey, 'process', 'svc' || o_custkey || '.exe', 'process-1-' || o_custkey || '-' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') FROM orders WHERE o_custkey % 2 = 1
    UNION ALL SELECT o_orderkey, 'file', 'n' || o_orderkey || '.TXT', 'file-s-' || o_orderkey FROM orders""")
def dump_rows_map(spark, sf_dir):
    """Rows of dumped resource usage tables and of jump lists."""
    k, c = F.col("k"), F.col("c")
    usage = wrapped(spark, sf_dir, [{}], {"TableAlias": F.when(c % 2 == 0, "NetworkDataUsage").otherwise("ApplicationResourceUsage"), "AppId": F.lit(1), "UserId": c, "InterfaceLuid": F.lit(3), "TimeStamp": F.col("t"), "BytesSent": F.lit(4), "BytesRecvd": k, "AppIdName": F.concat(F.lit("\\device\\h\\svc"), c, F.lit(".exe")), "Path": F.concat(F.lit("C:\\n"), k, F.lit(".TXT")), "SourceFile": F.lit("s"), "EntryNumber": k})
    return told(usage, ["esedump_srum", "jlecmd_dest"], ["exe", "file_name"], ["uid"]).select("k", "object", "what", "guid")


@query("""SELECT CASE WHEN o_custkey % 4 = 3 THEN 'positional' ELSE 'intrinsic' END AS scope, CASE o_custkey % 4 WHEN 1 THEN '["guid"]' WHEN 2 THEN '["object","guid"]' ELSE '[]' END AS problems, o_custkey % 4 < 3 AS equatable, count(*) AS n
    FROM orders GROUP BY ALL""")
def identity_checks(spark, sf_dir):
    """Minted identities checked by minting them again: sound ones, of a changed guid or key, and by place."""
    k, c = F.col("k"), F.col("c")
    rows = wrapped(spark, sf_dir, [{"timestamp_desc": F.lit("Creation Time"), "name": F.concat(F.lit("/f"), k), "file_reference": F.when(c % 4 != 3, c)}])
    events = maps.apply(rows, {"l2t_mft": maps.MAPS["l2t_mft"]}).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 4).alias("kind")), "k")
    changed = F.transform_values("native", lambda name, v: F.when((F.col("kind") == 2) & (name == identities.KEY), F.replace(v, F.lit('"file"'), F.lit('"flow"'))).otherwise(v))
    events = events.withColumns({"guid": F.when(F.col("kind") == 1, F.lit("00000000-0000-5000-8000-000000000000")).otherwise(F.col("guid")), "native": changed})
    of = lambda f: f(F.col("guid"), F.col("car_object"), F.col("source_artefact"), F.col("native"))
    return events.groupBy(F.col("native")[identities.SCOPE].alias("scope"), F.to_json(of(identities.problems)).alias("problems"), of(identities.equatable).alias("equatable")).agg(F.count("*").alias("n"))
