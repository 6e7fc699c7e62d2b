"""Maps of further tools, and the adapters before maps, as queries over the test tables, each with the SQL that it must equal.

Records are made of table rows, written as JSON and parsed as a scan would; what an event tells is compared as a list of its
fields in the order of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.plans import maps
from evidentia.plans.queries import as_records, data_list, query, table


def text(*parts: Column | str) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def of_kind(kind: Column, values: dict[object, object]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), kind)


def told(events: DataFrame, fields: list[str]) -> DataFrame:
    details = F.concat_ws(";", *(F.concat(F.lit(f"{f}="), F.try_element_at("props", F.lit(f))) for f in sorted(fields)))
    return events.select(F.col("car_object").alias("object"), F.col("car_action").alias("action"), "guid", details.alias("details"))


@query(r"""WITH e AS (SELECT *, 'host' || (user_id % 7) AS h, 'host' || (user_id % 7) || '.example' AS c FROM events)
    SELECT 'user_session' AS object, CASE WHEN user_id % 4 = 2 THEN 'unlock' ELSE 'login' END AS action, 'user_session-' || c || '-Security-' || event_id AS guid,
        concat_ws(';', 'hostname=' || h, 'login_id=0x1' || event_id, 'login_type=' || ['interactive', 'network', 'unlock', 'remote_interactive'][user_id % 4 + 1], CASE WHEN user_id % 3 > 0 THEN 'src_ip=10.0.0.' || (user_id % 250) END, CASE WHEN event_id % 2 = 1 THEN 'src_port=99' END, 'user=u' || user_id) AS details
        FROM e WHERE event_type = 'signup'
    UNION ALL SELECT 'user_session', 'logout', 'user_session-' || c || '-Security-' || event_id, concat_ws(';', 'hostname=' || h, 'login_id=0x1' || event_id, 'login_type=interactive', 'user=u' || user_id) FROM e WHERE event_type = 'error'
    UNION ALL SELECT 'process', 'create', 'process-' || c || '-Security-' || event_id, concat_ws(';', 'command_line=p ' || event_id, 'exe=C:\w\p' || user_id || '.exe', 'hostname=' || h, 'pid=' || (event_id + 4096), 'ppid=' || user_id, 'user=' || CASE user_id % 2 WHEN 0 THEN 'SYSTEM' ELSE 'u' || user_id END) FROM e WHERE event_type = 'view'
    UNION ALL SELECT 'service', 'create', 'service-' || c || '-Security-' || event_id, concat_ws(';', 'command_line="C:\s\a b' || user_id || '.exe" -k', 'exe=a b' || user_id || '.exe', 'hostname=' || h, 'name=n' || user_id, 'user=SYSTEM') FROM e WHERE event_type = 'click'
    UNION ALL SELECT 'service', 'create', 'service-' || c || '-System-' || event_id, concat_ws(';', 'command_line=C:\s\v' || user_id || '.exe -x', 'exe=v' || user_id || '.exe', 'hostname=' || h, 'name=n' || user_id, 'user=CORP\u' || user_id) FROM e WHERE event_type = 'purchase'""")
def evtx_accounts_map(spark, sf_dir):
    """Sessions, processes and services of the event log."""
    e = table(spark, sf_dir, "events")
    user, kind, event = F.col("user_id"), F.col("event_type"), F.col("event_id")
    session = {"TargetUserName": text("u", user), "TargetLogonId": text("0x1", event)}
    address = F.when(user % 3 == 0, "127.0.0.1").otherwise(text("10.0.0.", user % 250))
    account = F.when(user % 2 == 0, "NT AUTHORITY\\SYSTEM").otherwise(text("u", user))
    bodies = {
        "signup": data_list(**session, LogonType=of_kind(user % 4, {0: 2, 1: 3, 2: 7, 3: 10}), IpAddress=address, IpPort=event % 2 * 99),
        "error": data_list(**session, LogonType=F.lit(2)),
        "view": data_list(NewProcessName=text("C:\\w\\p", user, ".exe"), NewProcessId=text("0x", F.lower(F.hex(event + 4096))), ProcessId=user, CommandLine=text("p ", event), SubjectUserName=account),
        "click": data_list(ServiceName=text("n", user), ServiceFileName=text('"C:\\s\\a b', user, '.exe" -k'), ServiceAccount=F.lit("LocalSystem")),
        "purchase": data_list(ServiceName=text("n", user), ImagePath=text("C:\\s\\v", user, ".exe -x"), AccountName=text("CORP\\u", user)),
    }
    records = as_records(e, {
        "EventId": of_kind(kind, {"signup": 4624, "error": 4634, "view": 4688, "click": 4697, "purchase": 7045}), "Channel": of_kind(kind, {k: "System" if k == "purchase" else "Security" for k in bodies}),
        "Computer": text("host", user % 7, ".example"), "EventRecordId": event, "TimeCreated": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "Payload": F.coalesce(*(F.when(kind == k, b) for k, b in bodies.items())),
    })
    events = maps.apply(records, {m: maps.MAPS[m] for m in ("evtx_security_sessions", "evtx_process", "evtx_services")})
    return told(events, ["hostname", "login_id", "login_type", "src_ip", "src_port", "user", "exe", "pid", "ppid", "command_line", "name"])


@query(r"""WITH e AS (SELECT *, event_id % 11 AS n, '-host' || (user_id % 7) || '.example-Microsoft-Windows-Sysmon/Operational-' || event_id AS id, 'C:\i\p' || user_id || '.exe' AS image FROM events)
    SELECT CASE WHEN n IN (0, 1, 8) THEN 'process' WHEN n = 2 THEN 'flow' WHEN n IN (3, 4) THEN 'file' WHEN n IN (5, 6) THEN 'registry' WHEN n = 7 THEN 'module' WHEN n = 9 THEN 'thread' ELSE 'driver' END AS object,
        CASE n WHEN 0 THEN 'create' WHEN 1 THEN 'terminate' WHEN 2 THEN 'start' WHEN 3 THEN 'create' WHEN 4 THEN 'delete' WHEN 5 THEN CASE user_id % 2 WHEN 0 THEN 'add' ELSE 'remove' END WHEN 6 THEN 'value_edit' WHEN 7 THEN 'load' WHEN 8 THEN 'access' WHEN 9 THEN 'remote_create' ELSE 'load' END AS action,
        CASE WHEN n IN (0, 1) THEN '{g' || user_id || '}' WHEN n = 8 THEN 'process' || id WHEN n = 2 THEN 'flow' || id WHEN n IN (3, 4) THEN 'file' || id WHEN n IN (5, 6) THEN 'registry' || id WHEN n = 7 THEN 'module' || id WHEN n = 9 THEN 'thread' || id ELSE 'driver' || id END AS guid,
        CASE n WHEN 0 THEN 'image_path=' || image || ';md5_hash=ab' || event_id || ';parent_image_path=C:\q.exe;pid=' || user_id || ';ppid=7;user=LOCAL SERVICE'
            WHEN 1 THEN 'image_path=' || image || ';pid=' || user_id || ';user=LOCAL SERVICE'
            WHEN 2 THEN 'dest_ip=1.2.3.4;dest_port=443;image_path=' || image || ';network_direction=' || CASE user_id % 2 WHEN 0 THEN 'outbound' ELSE 'inbound' END || ';pid=' || user_id || ';user=LOCAL SERVICE'
            WHEN 3 THEN 'creation_time=2024-01-01T00:00:00;extension=txt;file_path=C:\d\f' || event_id || '.TXT;image_path=' || image || ';pid=' || user_id || ';user=LOCAL SERVICE'
            WHEN 4 THEN 'extension=txt;file_path=C:\d\f' || event_id || '.TXT;image_path=' || image || ';md5_hash=ab' || event_id || ';pid=' || user_id || ';user=LOCAL SERVICE'
            WHEN 5 THEN 'image_path=' || image || ';key=HKLM\k' || event_id || '\v;pid=' || user_id || ';user=LOCAL SERVICE'
            WHEN 6 THEN 'data=d' || event_id || ';image_path=' || image || ';key=HKLM\k' || event_id || '\v;pid=' || user_id || ';user=LOCAL SERVICE;value=v'
            WHEN 7 THEN 'image_path=' || image || ';md5_hash=ab' || event_id || ';module_name=m.dll;pid=' || user_id || CASE user_id % 2 WHEN 0 THEN ';signature_valid=true' ELSE '' END
            WHEN 8 THEN 'access_level=0x1410;image_path=C:\src.exe;pid=' || user_id || ';target_pid=9'
            WHEN 9 THEN 'start_module_name=m.dll;tgt_pid=9'
            ELSE 'image_path=C:\w\m.dll;md5_hash=ab' || event_id || ';module_name=m.dll' || CASE user_id % 2 WHEN 0 THEN ';signature_valid=true' ELSE '' END END AS details FROM e""")
def sysmon_map(spark, sf_dir):
    """Records of the system monitor, of eleven kinds."""
    e = table(spark, sf_dir, "events")
    user, event, n = F.col("user_id"), F.col("event_id"), F.col("event_id") % 11
    among = lambda *kinds: n.isin(*kinds)
    body = data_list(
        UtcTime=F.lit("2024-01-01 00:00:00"), ProcessGuid=text("{g", user, "}"), ProcessId=user, Image=text("C:\\i\\p", user, ".exe"), User=F.lit("NT AUTHORITY\\LOCAL SERVICE"),
        Hashes=text("SHA1=00,MD5=AB", event), ParentProcessGuid=F.lit("{q}"), ParentImage=F.lit("C:\\q.exe"), ParentProcessId=F.lit(7), DestinationIp=F.lit("1.2.3.4"), DestinationPort=F.lit(443),
        Initiated=F.when(user % 2 == 0, "true").otherwise("false"), TargetFilename=text("C:\\d\\f", event, ".TXT"), CreationUtcTime=F.lit("2024-01-01 00:00:00"), EventType=F.when(user % 2 == 0, "CreateKey").otherwise("DeleteKey"),
        TargetObject=text("HKLM\\k", event, "\\v"), Details=text("d", event), ImageLoaded=F.lit("C:\\w\\m.dll"), SignatureStatus=F.when(user % 2 == 0, "Valid").otherwise("Expired"),
        SourceImage=F.lit("C:\\src.exe"), SourceProcessId=user, TargetProcessId=F.lit(9), GrantedAccess=F.lit("0x1410"), StartModule=F.lit("C:\\w\\m.dll"),
    )
    records = as_records(e, {
        "EventId": of_kind(n, {0: 1, 1: 5, 2: 3, 3: 11, 4: 23, 5: 12, 6: 13, 7: 7, 8: 10, 9: 8, 10: 6}), "Provider": F.lit("Microsoft-Windows-Sysmon"), "Channel": F.lit("Microsoft-Windows-Sysmon/Operational"),
        "Computer": text("host", user % 7, ".example"), "EventRecordId": event, "TimeCreated": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "Payload": body,
    })
    events = maps.apply(records, {"evtx_sysmon": maps.MAPS["evtx_sysmon"]})
    kinds = ["image_path", "md5_hash", "parent_image_path", "pid", "ppid", "user", "dest_ip", "dest_port", "network_direction", "creation_time", "extension", "file_path", "key", "value", "data", "module_name", "signature_valid", "access_level", "target_pid", "start_module_name", "tgt_pid"]
    return told(events, kinds)


@query("""SELECT 'flow' AS object, 'message' AS action, 'flow-D' || o_orderkey || '-' || (o_custkey % 9) AS guid, 'application_protocol=dns;dest_ip=9.9.9.9;fqdn=n' || o_custkey || '.example;src_ip=10.0.0.' || (o_orderkey % 250) AS details FROM orders WHERE o_orderkey % 4 > 0
    UNION ALL SELECT 'http', CASE o_orderkey % 5 WHEN 0 THEN 'get' WHEN 1 THEN 'post' WHEN 2 THEN 'put' ELSE 'tunnel' END, 'http-H' || o_orderkey || '-1',
        'requester_ip_address=10.0.0.' || (o_orderkey % 250) || ';response_status_code=200;url_domain=web' || (o_custkey % 20) || '.example' || CASE WHEN o_orderkey % 5 < 3 THEN ';url_full=http://Web' || (o_custkey % 20) || '.example/p' || o_orderkey ELSE '' END || ';url_remainder=/p' || o_orderkey FROM orders WHERE o_orderkey % 5 < 4
    UNION ALL SELECT 'email', 'deliver', 'email-M' || o_orderkey || '-1', 'dest_ip=9.9.9.9;' || CASE WHEN o_custkey % 2 = 0 THEN 'src_address=a' || o_custkey || '@Mail.example;src_domain=mail.example' ELSE 'src_address=b@x.example;src_domain=x.example' END || ';src_ip=10.0.0.' || (o_orderkey % 250) || ';subject=s' || o_orderkey FROM orders
    UNION ALL SELECT 'file', 'create', 'file-F' || o_orderkey, 'extension=pdf;file_name=d' || o_orderkey || '.PDF;md5_hash=ab' || o_custkey || ';mime_type=application/pdf' FROM orders WHERE o_orderkey % 3 > 0
    UNION ALL SELECT 'file', 'create', 'AB' || o_orderkey, 'sha256_hash=ab' || o_orderkey FROM orders""")
def zeek_protocols_map(spark, sf_dir):
    """Names, requests, mails, files and certificates of a network sensor."""
    o = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    five = {"ts": F.unix_seconds("o_orderdate"), "id.orig_h": text("10.0.0.", key % 250), "id.resp_h": F.lit("9.9.9.9")}
    records = {
        "zeek_dns": five | {"uid": text("D", key), "trans_id": customer % 9, "query": F.when(key % 4 > 0, text("n", customer, ".example")), "proto": F.lit("udp")},
        "zeek_http": five | {"uid": text("H", key), "trans_depth": F.lit(1), "method": of_kind(key % 5, {0: "GET", 1: "post", 2: "PUT", 3: "CONNECT", 4: "HEAD"}), "host": text("Web", customer % 20, ".example"), "uri": text("/p", key), "status_code": F.lit(200)},
        "zeek_smtp": five | {"uid": text("M", key), "trans_depth": F.lit(1), "mailfrom": F.when(customer % 2 == 0, text("a", customer, "@Mail.example")), "from": F.lit("b@x.example"), "subject": text("s", key)},
        "zeek_files": {"ts": five["ts"], "fuid": F.when(key % 3 > 0, text("F", key)), "filename": text("d", key, ".PDF"), "mime_type": F.lit("application/pdf"), "md5": text("AB", customer)},
        "zeek_x509": {"ts": five["ts"], "fingerprint": text("AB", key)},
    }
    out = None
    for name, fields in records.items():
        rows = told(maps.apply(as_records(o, fields), {name: maps.MAPS[name]}), ["application_protocol", "dest_ip", "fqdn", "src_ip", "requester_ip_address", "response_status_code", "url_domain", "url_full", "url_remainder", "src_address", "src_domain", "subject", "extension", "file_name", "md5_hash", "mime_type", "sha256_hash"])
        out = rows if out is None else out.unionByName(rows)
    return out


@query(r"""SELECT 'registry' AS object, 'value_edit' AS action, 'registry-C:\Users\u' || (o_custkey % 50) || '\NTUSER.DAT-ROOT\k' || o_orderkey || '-v' AS guid, 'data=d' || o_orderkey || ';hive=NtUser;key=ROOT\k' || o_orderkey || ';type=RegSz;user=u' || (o_custkey % 50) || ';value=v' AS details FROM orders WHERE o_orderkey % 4 > 0
    UNION ALL SELECT 'process', 'create', 'process-P' || o_orderkey || '.EXE-H' || o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'exe=p' || o_orderkey || '.exe;image_path=\VOLUME\w\p' || o_orderkey || '.exe' ELSE 'exe=P' || o_orderkey || '.EXE' END FROM orders""")
def registry_and_prefetch_map(spark, sf_dir):
    """Registry values of a batch tool, deleted ones left out, and programs of prefetch files."""
    o = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    values = as_records(o, {
        "HivePath": text("C:\\Users\\u", customer % 50, "\\NTUSER.DAT"), "HiveType": F.lit("NtUser"), "KeyPath": text("ROOT\\k", key), "ValueName": F.lit("v"), "ValueType": F.lit("RegSz"), "ValueData": text("d", key),
        "LastWriteTimestamp": F.lit("2024-01-01 00:00:00"), "Deleted": key % 4 == 0,
    })
    programs = as_records(o, {"Executable": text("P", key, ".EXE"), "Hash": text("H", customer), "Path": F.when(key % 2 == 0, text("\\VOLUME\\w\\p", key, ".exe")), "LastRun": F.lit("2024-01-01T00:00:00Z")})
    fields = ["data", "hive", "key", "type", "user", "value", "exe", "image_path"]
    return told(maps.apply(values, {"recmd_batch": maps.MAPS["recmd_batch"]}), fields).unionByName(told(maps.apply(programs, {"prefetch_dump": maps.MAPS["prefetch_dump"]}), fields))


@query(r"""WITH e AS (SELECT *, 'pc' || (user_id % 7) || '.example' AS c FROM events)
    SELECT 'authentication' AS object, 'success' AS action, 'authentication-' || c || '-Security-' || event_id AS guid, 'app_name=w.exe;target_user=u' || user_id || ';user=SYSTEM' AS details FROM e WHERE event_type = 'signup'
    UNION ALL SELECT 'user_session', 'login', 'user_session-' || c || '-Security-' || event_id, 'login_id=0x1' || event_id || ';src_ip=10.0.0.' || (user_id % 250) || ';user=u' || user_id FROM e WHERE event_type = 'signup'
    UNION ALL SELECT 'user_session', 'reconnect', 'user_session-' || c || '-Microsoft-Windows-TerminalServices-LocalSessionManager/Operational-' || event_id, 'src_ip=10.1.0.' || (user_id % 250) || ';user=D\u' || user_id FROM e WHERE event_type = 'view'
    UNION ALL SELECT 'process', 'create', '{g' || event_id || '}', 'command_line=c' || event_id || ';image_path=C:\p.exe;parent_image_path=C:\q.exe;user=u' || user_id FROM e WHERE event_type = 'click'
    UNION ALL SELECT 'http', 'get', 'http-' || c || '-Microsoft-Windows-Bits-Client/Operational-' || event_id, 'url_full=https://d.example/' || event_id FROM e WHERE event_type = 'purchase'""")
def winevt_adapter_map(spark, sf_dir):
    """Event log rows of a timeline, whose strings have positions only, through the adapter and the event log maps."""
    e = table(spark, sf_dir, "events")
    user, kind, event = F.col("user_id"), F.col("event_type"), F.col("event_id")
    no = F.lit("-")
    logon = [F.lit("S-1-5-18"), F.lit("NT AUTHORITY\\SYSTEM"), no, F.lit("0x3e7"), F.lit("S-1-5-21-1"), text("u", user), no, text("0x1", event), F.lit("3"), no, no, no, no, no, no, no, no, F.lit("C:\\w.exe"), text("10.0.0.", user % 250), F.lit("0")]
    started = [no, no, text("{g", event, "}"), F.lit("5"), F.lit("C:\\p.exe"), no, no, no, no, text("c", event), no, text("u", user), no, no, no, no, no, F.lit("{q}"), F.lit("4"), F.lit("C:\\q.exe"), no]
    strings = {"signup": logon, "view": [text("D\\u", user), F.lit("3"), text("10.1.0.", user % 250)], "click": started, "purchase": [no, no, no, text("https://d.example/", event)]}
    channels = {"signup": "Security", "view": "Microsoft-Windows-TerminalServices-LocalSessionManager/Operational", "click": "Microsoft-Windows-Sysmon/Operational", "purchase": "Microsoft-Windows-Bits-Client/Operational", "error": "Other"}
    record = F.struct(
        of_kind(kind, {"signup": 4624, "view": 25, "click": 1, "purchase": 59, "error": 4624}).alias("event_identifier"), F.coalesce(*(F.when(kind == k, F.array(*v)) for k, v in strings.items())).alias("strings"), event.alias("record_number"),
        text("<Event><Channel>", of_kind(kind, channels), "</Channel><Computer>pc", user % 7, ".example</Computer></Event>").alias("xml_string"), F.when(kind == "click", "Microsoft-Windows-Sysmon").alias("source_name"),
    )
    rows = as_records(e, {"Timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "Record": record})
    return told(maps.mapped(rows, maps.route("image.L2tWinevt.jsonl")), ["app_name", "target_user", "login_id", "src_ip", "command_line", "image_path", "parent_image_path", "url_full", "user"])


@query(r"""WITH n AS (SELECT *, unnest(range(o_orderkey % 4)) AS i FROM orders)
    SELECT 'file' AS object, 'read' AS action, 'file-s' || o_orderkey || '-' || i AS guid, 'extension=txt;file_name=f' || i || '.txt;file_path=C:\d' || o_custkey || '\f' || i || '.txt;hostname=h' || (o_custkey % 5) AS details,
        strftime(to_timestamp(1500000000 + o_orderkey * 10 + i) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' AS at, 'a' || (o_custkey % 9) AS program FROM n""")
def jump_list_map(spark, sf_dir):
    """Entries of jump lists, nested in a record for each list, as opened files."""
    o = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    entry = lambda i: F.struct(text("C:\\d", customer, "\\f", i, ".txt").alias("Path"), text("/Date(", (1500000000 + key * 10 + i) * 1000, ")/").alias("LastModified"), text("h", customer % 5).alias("Hostname"), i.alias("EntryNumber"))
    entries = F.when(key % 4 > 0, F.transform(F.sequence(F.lit(0), key % 4 - 1), entry))
    lists = as_records(o, {"SourceFile": text("s", key), "AppId": F.struct(text("a", customer % 9).alias("AppId")), "DestListEntries": entries})
    events = maps.mapped(lists, maps.route("x/gojle/asset.jsonl"))
    more = events.select("guid", F.col("timestamp").alias("at"), F.try_element_at("native", F.lit("AppId")).alias("program"), "car_object", "car_action", "props")
    fields = ["extension", "file_name", "file_path", "hostname"]
    details = F.concat_ws(";", *(F.concat(F.lit(f"{f}="), F.try_element_at("props", F.lit(f))) for f in fields))
    return more.select(F.col("car_object").alias("object"), F.col("car_action").alias("action"), "guid", details.alias("details"), "at", "program")
