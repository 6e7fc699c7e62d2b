"""The links, relations and nodes of a case as queries over the test tables, each with the SQL that it must equal.

The table events stands for one source of seven hosts: a signup starts a process of its user and day, an error ends it, a view
makes a file, a click a thread in another process, a purchase a registry value.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.operators import fold, graph
from evidentia.plans import build, derived, exchange, links, observables
from evidentia.plans.queries import query, table
from evidentia.plans.tables import written
from evidentia.sources import hits


def model_rows(rows: DataFrame, kind: Column, action: Column, guid: Column, ts: Column, props: Mapping[str, Column], native: Mapping[str, Column], **more: Column) -> DataFrame:
    """Rows of the event model with these bags, as a written table."""
    columns = {
        "source": F.lit("s"), "source_host": F.lit(None).cast("string"), "car_object": kind, "car_action": action, "guid": guid, "timestamp": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "ts": ts, "source_artefact": F.lit("a"),
        "owning_pid": F.lit(None).cast("string"), "owning_guid_native": F.lit(None).cast("string"), "parent_pid": F.lit(None).cast("string"), "row_id": F.lit(None).cast("string"),
    } | more
    return written(rows.select(*(v.alias(k) for k, v in columns.items()), links.known(props).alias("props"), links.known(native).alias("native")))


def case(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    user, kind, event, day = F.col("user_id"), F.col("event_type"), F.col("event_id"), F.dayofmonth("ts")
    is_ = lambda *names: kind.isin(*names)
    process = lambda u: F.concat(F.lit("p"), u, F.lit("-"), day)
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    number = F.floor(user / 7)
    pick = lambda table: F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), kind)
    parent = F.when(user % 10 == 0, number).otherwise(user * 3 % 22)
    target = F.when(event % 5 == 0, process(user)).otherwise(process((user + 7) % 150))
    return model_rows(
        e,
        pick({"signup": "process", "error": "process", "view": "file", "click": "thread", "purchase": "registry"}), pick({"signup": "create", "error": "terminate", "view": "create", "click": "remote_create", "purchase": "value_edit"}),
        F.when(is_("signup", "error"), process(user)).otherwise(text(F.substring(kind, 1, 1), event)), F.col("ts"),
        {
            "pid": F.when(is_("signup"), number), "exe": F.when(is_("signup"), text("e", user, ".exe")), "image_path": F.when(is_("signup"), text("C:\\e", user, ".exe")),
            "file_path": F.when(is_("view"), text("c:\\E", event % 200, ".EXE")), "new_content": F.when(is_("purchase"), text("v", event)), "tgt_pid": F.when(is_("click"), event % 9),
        },
        {
            "ParentProcessGuid": F.when(is_("signup") & (event % 4 == 0), process(user - 7)), "TargetProcessGuid": F.when(is_("click"), target), "StartAddress": F.when(is_("click"), text("0x", event)),
        },
        source_host=text("h", user % 7), row_id=F.lpad(event.cast("string"), 12, "0"),
        owning_pid=F.when(is_("view"), text("0x", F.lower(F.hex(number)))).when(is_("purchase"), number.cast("string")),
        owning_guid_native=F.when(is_("click") | (is_("view") & (event % 3 == 0)), process(user)), parent_pid=F.when(is_("signup"), parent.cast("string")),
    )


def linked_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = case(spark, sf_dir)
    return written(links.with_facts(rows, links.stages(rows)))


CASE_SQL = r"""
e AS (SELECT event_id, user_id, event_type, ts, lpad(event_id::VARCHAR, 12, '0') AS row_id, 'h' || (user_id % 7) AS host, 'p' || user_id || '-' || day(ts) AS own, user_id // 7 AS number,
    CASE WHEN event_type IN ('signup', 'error') THEN 'p' || user_id || '-' || day(ts) ELSE event_type[1:1] || event_id END AS guid,
    CASE WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'p' || user_id || '-' || day(ts) WHEN event_type = 'click' THEN 'p' || ((user_id + 7) % 150) || '-' || day(ts) END AS target FROM events),
ended AS (SELECT host, own, min(ts) AS ended FROM e WHERE event_type = 'error' GROUP BY ALL),
made AS (SELECT e.*, ended FROM e LEFT JOIN ended USING (host, own) WHERE event_type = 'signup'),
asking AS (
    SELECT row_id, host, ts, event_type = 'signup' AS birth,
        CASE WHEN event_type = 'click' OR (event_type = 'view' AND event_id % 3 = 0) THEN own WHEN event_type = 'signup' AND event_id % 4 = 0 THEN 'p' || (user_id - 7) || '-' || day(ts) END AS told,
        CASE WHEN event_type IN ('view', 'purchase') THEN number WHEN event_type = 'signup' AND user_id % 10 = 0 THEN number WHEN event_type = 'signup' THEN user_id * 3 % 22 END AS pid
    FROM e WHERE event_type <> 'error'),
named AS (SELECT host, own, arg_max(row_id, (ts, row_id)) AS m FROM made GROUP BY ALL),
sure AS (SELECT row_id, m, 'definitive' AS confidence FROM asking a JOIN named n ON a.host = n.host AND a.told = n.own),
likely AS (
    SELECT a.row_id, arg_max(m.row_id, (m.ts, m.row_id)) AS m, 'heuristic' AS confidence FROM asking a JOIN made m ON a.host = m.host AND a.pid = m.number AND m.ts <= a.ts AND (m.ended IS NULL OR m.ended >= a.ts)
    WHERE a.row_id NOT IN (SELECT row_id FROM sure) GROUP BY 1),
found AS (SELECT * FROM (SELECT * FROM sure UNION ALL SELECT * FROM likely) WHERE m <> row_id),
linked AS (
    SELECT e.*, CASE WHEN e.event_type <> 'signup' THEN m.own END AS owner_guid, CASE WHEN e.event_type = 'signup' THEN m.own END AS parent_guid, f.confidence, m.user_id AS by_user
    FROM e LEFT JOIN found f USING (row_id) LEFT JOIN made m ON m.row_id = f.m),
runs AS (SELECT host, lower('C:\e' || user_id || '.exe') AS path, arg_min(own, (ts, row_id)) AS first, count(*) AS n FROM made GROUP BY ALL),
aimed AS (
    SELECT l.*, r.first AS ran, r.n AS runs, CASE WHEN n.own IS NOT NULL AND n.own IS DISTINCT FROM l.owner_guid THEN n.own END AS hit
    FROM linked l LEFT JOIN runs r ON l.event_type = 'view' AND r.host = l.host AND r.path = lower('c:\E' || (event_id % 200) || '.EXE') LEFT JOIN named n ON n.host = l.host AND n.own = l.target)"""


@query(f"WITH {CASE_SQL} " + r"""
    SELECT row_id, owner_guid, parent_guid, confidence AS link_confidence, CASE WHEN event_type = 'signup' THEN 'C:\e' || user_id || '.exe' WHEN event_type IN ('view', 'purchase') THEN 'C:\e' || by_user || '.exe' END AS image,
        CASE WHEN event_type = 'signup' THEN 'e' || by_user || '.exe' END AS parent_exe FROM linked""")
def owners_and_parents(spark, sf_dir):
    """Owners of events and parents of processes, by identity, else by number and lifetime; a process is not its own parent."""
    rows = case(spark, sf_dir)
    out = links.with_facts(rows, [links.process_facts(rows, links.processes(rows))])
    return out.select("row_id", "owner_guid", "parent_guid", "link_confidence", links.prop("image_path").alias("image"), links.prop("parent_exe").alias("parent_exe"))


@query(f"WITH {CASE_SQL} SELECT row_id, ran AS executed_as, CASE WHEN runs > 1 THEN runs END AS runs, hit AS put_into FROM aimed WHERE event_type IN ('view', 'click')")
def executed_files_and_injections(spark, sf_dir):
    """Files that a process was started from, by path, and the processes that threads were put into."""
    rows = linked_case(spark, sf_dir).where("car_object IN ('file', 'thread')")
    return rows.select("row_id", links.native("executed_as_process_guid").alias("executed_as"), links.native("executed_as_process_count").cast("long").alias("runs"), links.native("target_process_guid").alias("put_into"))


METHOD_SQL = "CASE confidence WHEN 'definitive' THEN 'native_guid' WHEN 'heuristic' THEN 'pid_window' END"


@query(f"WITH {CASE_SQL} " + f"""
    SELECT CASE event_type WHEN 'purchase' THEN 'modified' ELSE 'created' END AS relationship, owner_guid AS source_guid, CASE event_type WHEN 'view' THEN 'file' WHEN 'click' THEN 'thread' ELSE 'registry' END AS target_object, guid AS target_guid,
        confidence, {METHOD_SQL} AS method, CASE WHEN event_type = 'purchase' THEN '{{"new_content":"v' || event_id || '"}}' END AS properties FROM aimed WHERE owner_guid IS NOT NULL
    UNION ALL SELECT 'created', parent_guid, 'process', guid, confidence, {METHOD_SQL}, NULL FROM aimed WHERE parent_guid <> guid
    UNION ALL SELECT 'executed', ran, 'file', guid, 'heuristic', 'image_path', NULL FROM aimed WHERE ran IS NOT NULL
    UNION ALL SELECT 'accessed', owner_guid, 'process', hit, 'definitive', 'native_guid', '{{"start_address":"0x' || event_id || '"}}' FROM aimed WHERE hit IS NOT NULL AND owner_guid IS NOT NULL""")
def declared_relations(spark, sf_dir):
    """All relations of the linked case, with the facts that are of the relation itself."""
    return build.edges(linked_case(spark, sf_dir)).select("relationship", "source_guid", "target_object", "target_guid", "confidence", "method", "properties")


MISSING_SQL = r"""
asked AS (
    SELECT row_id, ts, host, guid AS seen, 'owning_process' AS rule, own AS node, 'native_guid' AS method, 0 AS no, 'pid' AS property, CASE WHEN event_type = 'view' THEN format('0x{:x}', number) END AS value, event_id FROM aimed
        WHERE (event_type = 'click' OR (event_type = 'view' AND event_id % 3 = 0)) AND owner_guid IS NULL
    UNION ALL SELECT row_id, ts, host, guid, 'parent_process', 'p' || (user_id - 7) || '-' || day(ts), 'native_guid', 2, '', NULL, event_id FROM aimed WHERE event_type = 'signup' AND event_id % 4 = 0 AND parent_guid IS NULL
    UNION ALL SELECT row_id, ts, host, owner_guid, 'injection_target', target, 'native_guid', 3, 'pid', (event_id % 9)::VARCHAR, event_id FROM aimed WHERE event_type = 'click' AND hit IS NULL AND owner_guid IS NOT NULL),
missing AS (SELECT a.* FROM asked a WHERE node <> (SELECT x.guid FROM e x WHERE x.row_id = a.row_id) AND NOT EXISTS (SELECT 1 FROM e o WHERE o.event_type IN ('signup', 'error') AND o.host = a.host AND o.guid = a.node))"""


@query(f"""WITH {CASE_SQL}, {MISSING_SQL}
    SELECT host AS source_host, node AS node_id, array_to_string(list_transform(list_sort(list(DISTINCT no)), lambda x: ['owning_process', '', 'parent_process', 'injection_target'][x + 1]), '+') || ': referenced by ' || count(DISTINCT seen) || ' observed record(s) via guid; no process event observed (reconstructed, not evidence)' AS reason,
        list_sort(list(DISTINCT seen))[1:1][1] AS first_seen_by, count(DISTINCT seen) AS seen_by, arg_min(value, (no, ts, row_id)) FILTER (WHERE value IS NOT NULL AND property = 'pid') AS pid, count(DISTINCT value) FILTER (WHERE property = 'pid') AS pids,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM missing GROUP BY host, node""")
def inferred_nodes(spark, sf_dir):
    """Processes that rows refer to and none is of, with what is said of them."""
    n = derived.inferred_nodes(linked_case(spark, sf_dir))
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    more = F.size(F.from_json(F.get_json_object("conflicts", "$.pid"), "array<string>"))
    pid = F.try_element_at("properties", F.lit("pid"))
    return n.select(
        "source_host", "node_id", "reason", F.array_min("corroborated_by").alias("first_seen_by"), F.size("corroborated_by").cast("long").alias("seen_by"), pid.alias("pid"),
        F.when(pid.isNull(), 0).otherwise(1 + F.coalesce(F.greatest(more, F.lit(0)), F.lit(0))).cast("long").alias("pids"), at("first_seen").alias("first_at"), at("last_seen").alias("last_at"),
    )


@query(f"""WITH {CASE_SQL}, {MISSING_SQL}
    SELECT CASE rule WHEN 'injection_target' THEN 'accessed' ELSE 'created' END AS relationship, CASE rule WHEN 'injection_target' THEN seen ELSE node END AS source_guid, CASE rule WHEN 'injection_target' THEN node ELSE seen END AS target_guid,
        CASE rule WHEN 'injection_target' THEN 'target' ELSE 'source' END AS inferred_end, 'guid' AS identity_key, 'inferred' AS confidence, seen AS corroborated_by FROM missing""")
def inferred_relations(spark, sf_dir):
    """Relations that end on what was not observed."""
    edges = derived.inferred_edges(derived.references(linked_case(spark, sf_dir)))
    return edges.select("relationship", "source_guid", "target_guid", "inferred_end", "identity_key", "confidence", F.col("corroborated_by")[0].alias("corroborated_by"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins (signup), reconnections (view) and logouts (error) by logon identity, or by number; authentications (click, purchase)."""
    e = table(spark, sf_dir, "events")
    user, kind, event = F.col("user_id"), F.col("event_type"), F.col("event_id")
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    pick = lambda table: F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), kind)
    session = kind.isin("signup", "view", "error")
    luid = F.when(event % 3 != 0, F.when(event % 2 == 0, text("0xAB", event % 400)).otherwise(text("0xab", event % 400))).when(event % 9 == 0, F.lit("0x3e7"))
    return model_rows(
        e, F.when(session, "user_session").otherwise(F.lit("authentication")), pick({"signup": "login", "view": "reconnect", "error": "logout", "click": "success", "purchase": "failure"}), text(F.when(session, "s").otherwise(F.lit("a")), event), F.col("ts"),
        {"login_id": F.when(session, luid), "user": F.when(event % 2 == 0, "Local System").when(event % 5 == 0, text("u", user)), "uid": F.when(event % 4 == 0, "S-1-5-18").when(event % 4 == 1, text("S-1-5-21-1-2-3-", user)), "target_uid": F.when(~session & (event % 7 > 0), text("s-1-5-21-1-2-3-", user % 40)), "target_user": F.when(~session, text("t", user))},
        {"SessionID": F.when(session & (event % 5 < 2), event % 60), "TargetLogonId": F.when(~session, F.when(event % 6 == 0, "0x0").otherwise(text("0xAb", event % 500))), "SubjectLogonId": F.when(~session, F.when(event % 6 == 0, "0x3E7").otherwise(text("0xaB", event % 450)))},
        source_host=F.when(user % 3 > 0, text("h", user % 3)), row_id=F.lpad(event.cast("string"), 12, "0"),
    )


SESSIONS_SQL = """
e AS (SELECT event_id, user_id, event_type, ts, lpad(event_id::VARCHAR, 12, '0') AS row_id, CASE WHEN user_id % 3 > 0 THEN 'h' || (user_id % 3) ELSE '-' END AS host,
    event_type IN ('signup', 'view', 'error') AS session, CASE WHEN event_type IN ('signup', 'view', 'error') THEN 's' ELSE 'a' END || event_id AS guid,
    CASE WHEN event_id % 3 <> 0 THEN '0xab' || (event_id % 400) WHEN event_id % 9 = 0 THEN '0x3e7' END AS luid, CASE WHEN event_id % 5 < 2 THEN event_id % 60 END AS number FROM events),
opened AS (SELECT * FROM e WHERE event_type IN ('signup', 'view')), closed AS (SELECT * FROM e WHERE event_type = 'error'),
by_luid AS (SELECT host, luid, arg_min(row_id, (ts, row_id)) AS login FROM opened WHERE luid IS NOT NULL GROUP BY ALL),
by_number AS (SELECT host, number, arg_min(row_id, (ts, row_id)) AS login FROM opened WHERE number IS NOT NULL GROUP BY ALL),
pairs AS (SELECT c.row_id, c.ts, c.guid, coalesce(l.login, n.login) AS login FROM closed c LEFT JOIN by_luid l ON c.host = l.host AND c.luid = l.luid LEFT JOIN by_number n ON c.host = n.host AND c.number = n.number),
last AS (SELECT login, arg_max(guid, (ts, row_id)) AS guid, max(ts) AS ts FROM pairs WHERE login IS NOT NULL GROUP BY 1)"""


@query(f"""WITH {SESSIONS_SQL} SELECT e.row_id, o.guid AS login_guid, l.guid AS logout_guid, strftime(l.ts, '%Y-%m-%dT%H:%M:%S') AS session_end
    FROM e LEFT JOIN pairs p ON e.row_id = p.row_id LEFT JOIN e o ON o.row_id = p.login LEFT JOIN last l ON l.login = e.row_id WHERE e.session""")
def session_lifetimes(spark, sf_dir):
    """Logouts with the first login of their session, and logins with the last logout that closes them."""
    rows = sessions(spark, sf_dir)
    out = links.with_facts(rows, [links.session_facts(rows)]).where("car_object = 'user_session'")
    return out.select("row_id", links.native("session_login_guid").alias("login_guid"), links.native("session_logout_guid").alias("logout_guid"), F.substring(links.native("session_end"), 1, 19).alias("session_end"))


AUTH_SQL = """
seen AS (SELECT host, luid, arg_max(guid, (ts, row_id)) AS guid FROM e WHERE session AND luid IS NOT NULL GROUP BY ALL),
auth AS (SELECT e.*, CASE WHEN event_type = 'click' AND event_id % 6 <> 0 THEN '0xab' || (event_id % 500) END AS target, CASE WHEN event_id % 6 = 0 THEN '0x3e7' ELSE '0xab' || (event_id % 450) END AS subject FROM e WHERE NOT session),
ends AS (SELECT a.*, t.guid AS target_guid, s.guid AS subject_guid, CASE WHEN subject = '0x3e7' THEN 'heuristic' ELSE 'definitive' END AS tier FROM auth a LEFT JOIN seen t ON a.host = t.host AND a.target = t.luid LEFT JOIN seen s ON a.host = s.host AND a.subject = s.luid)"""


@query(f"""WITH {SESSIONS_SQL}, {AUTH_SQL} SELECT guid AS source_guid, target_guid, 'definitive' AS confidence FROM ends WHERE target_guid IS NOT NULL UNION ALL SELECT guid, subject_guid, tier FROM ends WHERE subject_guid IS NOT NULL""")
def authentication_sessions(spark, sf_dir):
    """Relations of authentications to the sessions that they opened and were requested from."""
    rows = sessions(spark, sf_dir)
    edges = build.edges(links.with_facts(rows, [links.authentication_facts(rows)]))
    return edges.where("method = 'luid'").select("source_guid", "target_guid", "confidence")


@query("""WITH e AS (SELECT *, 'S-1-5-21-1-2-3-' || user_id AS sid, 'S-1-5-21-1-2-3-' || (user_id % 40) AS other FROM events WHERE event_id % 4 = 1)
    SELECT 'created' AS relationship, 'sid:' || sid AS source_guid, 'user_session' AS target_object, 's' || event_id AS target_guid FROM e WHERE event_type = 'signup'
    UNION ALL SELECT 'attempted to authenticate', 'sid:' || sid, 'user_account', 'sid:' || other FROM e WHERE event_type IN ('click', 'purchase') AND event_id % 7 > 0 AND other <> sid""")
def actor_relations(spark, sf_dir):
    """Relations from accounts to their sessions and to the accounts that they authenticated as; well-known accounts are none."""
    upper = F.map_from_entries(F.transform(F.map_entries("props"), lambda e: F.struct(e["key"], F.when(e["key"] == "target_uid", F.upper(e["value"])).otherwise(e["value"]))))
    return derived.actors(sessions(spark, sf_dir).withColumn("props", upper)).select("relationship", "source_guid", "target_object", "target_guid")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 AND (event_id % 2 = 0 OR event_id % 5 <> 0) THEN 'SYSTEM' WHEN event_id % 2 = 0 THEN 'SYSTEM' WHEN event_id % 5 = 0 THEN 'u' || user_id END AS name FROM events""")
def account_names(spark, sf_dir):
    """Names of accounts: well-known ones by their identifier where the name is blank or another rendering."""
    return links.canonical(sessions(spark, sf_dir)).select(F.col("row_id").cast("long").alias("event_id"), links.prop("user").alias("name"))


@query("""WITH x AS (SELECT 'F' || c_custkey AS print, 'CN=' || c_mktsegment || c_custkey AS subject FROM customer WHERE c_custkey % 3 > 0),
    o AS (SELECT o_orderkey, ['F' || (o_custkey // 2), 'G' || o_custkey, 'F' || o_custkey] AS chain FROM orders),
    hits AS (SELECT o_orderkey, i, chain[i] AS print FROM o, (SELECT unnest([1, 2, 3]) AS i))
    SELECT 'c' || o_orderkey AS guid, arg_min(subject, i) AS subject FROM hits JOIN x USING (print) GROUP BY 1""")
def certificate_subjects(spark, sf_dir):
    """Subjects of the first certificate of a connection's chain that the sensor saw."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    seen = model_rows(
        c, F.lit("file"), F.lit("create"), F.concat(F.lit("F"), F.col("c_custkey")), F.lit(None).cast("timestamp"), {}, {"certificate.subject": F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("CN="), F.col("c_mktsegment"), F.col("c_custkey")))},
        source_artefact=F.lit("zeek_x509"), row_id=F.concat(F.lit("x"), F.col("c_custkey")),
    )
    chain = F.array(F.concat(F.lit("F"), F.floor(F.col("o_custkey") / 2)), F.concat(F.lit("G"), F.col("o_custkey")), F.concat(F.lit("F"), F.col("o_custkey")))
    flows = model_rows(o, F.lit("flow"), F.lit("message"), F.concat(F.lit("c"), F.col("o_orderkey")), F.col("o_orderdate"), {"application_protocol": F.lit("tls")}, {"cert_chain_fps": F.to_json(chain)}, source_artefact=F.lit("zeek_ssl"), row_id=F.concat(F.lit("c"), F.col("o_orderkey")))
    rows = seen.unionByName(flows)
    out = links.with_facts(rows, [links.certificate_facts(rows)]).where("car_object = 'flow'")
    return out.select("guid", links.native("server_cert_subject").alias("subject")).where("subject IS NOT NULL")


@query("""WITH q AS (SELECT c_custkey AS k, '10.' || (c_custkey % 50) || '.0.1' AS ip, 'n' || c_custkey || '.example' AS name FROM customer),
    first AS (SELECT ip, arg_min(name, lpad(k::VARCHAR, 9, '0')) AS name FROM q GROUP BY 1)
    SELECT 'c' || o_orderkey AS guid, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN 'own.example' END, d.name, CASE WHEN o_orderkey % 3 = 0 THEN 'sni' || o_orderkey END) AS dest, s.name AS src
    FROM orders LEFT JOIN first d ON d.ip = '10.' || (o_custkey % 80) || '.0.1' LEFT JOIN first s ON s.ip = '10.' || (o_custkey % 90) || '.0.1'""")
def connection_names(spark, sf_dir):
    """Names of both ends of connections: their own, else what queries resolved, else what handshakes asked for."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    flow, key = (F.lit("flow"), F.lit("message")), F.col("c_custkey")
    at = F.lit("2024-01-01").cast("timestamp")
    asked = model_rows(c, *flow, text("q", key), at, {"fqdn": text("n", key, ".example")}, {"answers": F.to_json(F.array(F.lit("alias"), text("10.", key % 50, ".0.1")))}, source_artefact=F.lit("zeek_dns"), row_id=text("q", F.lpad(key.cast("string"), 9, "0")))
    tls = model_rows(o.where("o_orderkey % 3 = 0"), *flow, text("c", order), at, {"dest_fqdn": text("sni", order)}, {}, source_artefact=F.lit("zeek_ssl"), row_id=text("t", order))
    conn = model_rows(o, *flow, text("c", order), at, {"dest_ip": text("10.", customer % 80, ".0.1"), "src_ip": text("10.", customer % 90, ".0.1"), "dest_fqdn": F.when(order % 4 == 0, "own.example")}, {}, source_artefact=F.lit("zeek_conn"), row_id=text("c", order))
    rows = asked.unionByName(tls).unionByName(conn)
    out = links.with_facts(rows, [links.name_facts(rows)]).where("source_artefact = 'zeek_conn'")
    return out.select("guid", links.prop("dest_fqdn").alias("dest"), links.prop("src_fqdn").alias("src"))


@query("""WITH f AS (SELECT event_id, ts, 'u' || user_id AS guid, event_type AS artefact, 'k' || (json_extract_string(props, '$.k')::INT % 3) AS k, CASE WHEN event_id % 3 = 0 THEN 'o' || (event_id % 2) END AS o FROM events),
    v AS (SELECT guid, 'key' AS field, k AS value, event_id, artefact FROM f UNION ALL SELECT guid, 'native.o', o, event_id, artefact FROM f WHERE o IS NOT NULL),
    d AS (SELECT guid, field, value, min(event_id) AS place, arg_min(artefact, event_id) AS artefact FROM v GROUP BY 1, 2, 3),
    c AS (SELECT guid, field, list({'source_artefact': artefact, 'value': value} ORDER BY place) AS l FROM d GROUP BY 1, 2)
    SELECT guid, count(*)::BIGINT AS contributions, (SELECT l[1].value FROM c WHERE c.guid = f.guid AND field = 'key') AS k, (SELECT l[1].value FROM c WHERE c.guid = f.guid AND field = 'native.o') AS o,
        (SELECT array_to_string(list_transform(l[2:], lambda x: x.source_artefact || '=' || x.value), ',') FROM c WHERE c.guid = f.guid AND field = 'key') AS k_others,
        (SELECT array_to_string(list_transform(l[2:], lambda x: x.source_artefact || '=' || x.value), ',') FROM c WHERE c.guid = f.guid AND field = 'native.o') AS o_others,
        (SELECT array_to_string(list(artefact ORDER BY first), ',') FROM (SELECT artefact, min(event_id) AS first FROM f x WHERE x.guid = f.guid GROUP BY 1)) AS sources FROM f GROUP BY guid""")
def fold_with_conflicts(spark, sf_dir):
    """Observations of one event as one row: first values, what others say otherwise, and who contributed."""
    e = table(spark, sf_dir, "events")
    k, event = F.concat(F.lit("k"), F.get_json_object("props", "$.k").cast("int") % 3), F.col("event_id")
    rows = model_rows(
        e, F.lit("registry"), F.lit("add"), F.concat(F.lit("u"), F.col("user_id")), F.lit(None).cast("timestamp"), {"key": k}, {"o": F.when(event % 3 == 0, F.concat(F.lit("o"), event % 2))},
        source_artefact=F.col("event_type"), row_id=F.lpad(event.cast("string"), 12, "0"),
    )
    out = fold.merged(rows.drop("ts"), ["source", "source_host", "car_object", "guid", "car_action"], ["row_id"])
    others = F.from_json(links.native("coalesced_conflicts"), "map<string, array<struct<source_artefact: string, value: string>>>")
    told = lambda field: F.coalesce(F.array_join(F.transform(F.try_element_at(others, F.lit(field)), lambda x: F.concat(x["source_artefact"], F.lit("="), x["value"])), ","), F.lit(""))
    return out.select(
        "guid", links.native("contributions").cast("long").alias("contributions"), links.prop("key").alias("k"), links.native("o").alias("o"), told("key").alias("k_others"), told("native.o").alias("o_others"),
        F.array_join(F.from_json(links.native("coalesced_sources"), "array<string>"), ",").alias("sources"),
    )


@query("""WITH p AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_partkey % 400 AS h, l_suppkey % 20 AS path FROM lineitem), f AS (SELECT p_partkey AS id, p_partkey % 300 AS h, p_size % 20 AS path FROM part),
    n AS (SELECT h, count(*) AS n, min('f' || id) AS id FROM f GROUP BY 1), m AS (SELECT h, path, count(*) AS n, min('f' || id) AS id FROM f GROUP BY 1, 2)
    SELECT 'p' || p.id AS source_guid, CASE WHEN n.n = 1 THEN n.id ELSE m.id END AS target_guid, 'sha1_hash' AS identity_key FROM p JOIN n ON p.h = n.h LEFT JOIN m ON p.h = m.h AND p.path = m.path WHERE n.n = 1 OR m.n = 1""")
def image_content_links(spark, sf_dir):
    """Processes and the one file of their image's hash, or the one of these with the image's path."""
    i, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    name = lambda c: F.concat(F.lit("C:\\P"), c)
    line = F.concat(F.lit("p"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    started = model_rows(i, F.lit("process"), F.lit("create"), line, F.lit(None).cast("timestamp"), {"sha1_hash": F.upper(F.sha1((F.col("l_partkey") % 400).cast("string"))), "image_path": name(F.col("l_suppkey") % 20)}, {}, row_id=line)
    item = F.concat(F.lit("f"), F.col("p_partkey"))
    files = model_rows(p, F.lit("file"), F.lit("create"), item, F.lit(None).cast("timestamp"), {"sha1_hash": F.sha1((F.col("p_partkey") % 300).cast("string")), "file_path": F.lower(name(F.col("p_size") % 20))}, {}, row_id=item)
    return derived.links(started.unionByName(files)).select("source_guid", "target_guid", "identity_key")


@query("""WITH d AS (SELECT doc_id, sha256(text) AS h, 'S-1-5-21-7-7-7-' || doc_id % 5 AS s, lang || ':' || source AS path, source AS usr FROM documents),
    r AS (SELECT 'sha256:' || h AS node_id, 'file_content' AS kind, 'sha256_hash' AS identity_key, doc_id, path AS value FROM d UNION ALL SELECT 'sid:' || s, 'user_account', 'owner_uid', doc_id, NULL FROM d),
    v AS (SELECT node_id, value, min(doc_id) AS place FROM r WHERE value IS NOT NULL GROUP BY 1, 2),
    l AS (SELECT node_id, array_to_string(list(value ORDER BY place), ',') AS paths FROM (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY place) <= 64) GROUP BY 1)
    SELECT node_id, kind, min(identity_key) AS identity_key, count(*) AS refs, any_value(paths) AS paths FROM r LEFT JOIN l USING (node_id) GROUP BY 1, 2""")
def content_identities(spark, sf_dir):
    """Hashes and accounts as nodes: how often they are referred to, and their first paths, 64 at most."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    rows = model_rows(
        d, F.lit("file"), F.lit("create"), F.concat(F.lit("f"), doc), F.lit(None).cast("timestamp"), {"sha256_hash": F.sha2("text", 256), "owner_uid": F.concat(F.lit("S-1-5-21-7-7-7-"), doc % 5), "file_path": F.concat_ws(":", "lang", "source")}, {},
        row_id=F.lpad(doc.cast("string"), 12, "0"),
    )
    n = derived.content_nodes(rows)
    return n.select("node_id", "kind", "identity_key", F.col("ref_count").alias("refs"), F.array_join(F.try_element_at("properties", F.lit("file_path")), ",").alias("paths"))


@query("""WITH k AS (SELECT doc_id, source, 1 AS rank, 'content' AS tier, sha256(text) AS join_key FROM documents WHERE text <> ''
        UNION ALL SELECT doc_id, source, 2, 'name', split_part(text, chr(10), 1) FROM documents WHERE split_part(text, chr(10), 1) <> ''),
    g AS (SELECT rank, tier, join_key, list_sort(list(DISTINCT doc_id)) AS members FROM k GROUP BY 1, 2, 3 HAVING count(DISTINCT source) >= 2),
    b AS (SELECT tier, join_key FROM g QUALIFY row_number() OVER (PARTITION BY members ORDER BY rank, join_key) = 1)
    SELECT DISTINCT tier, sha256(join_key) AS key_hash, doc_id, source FROM k JOIN b USING (tier, join_key)""")
def converging_members(spark, sf_dir):
    """Members of keys that two sources share, one row for each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("text") != "", F.sha2("text", 256)).alias("h"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("line"))
    return graph.member_sets(docs, [("content", F.col("h")), ("name", F.col("line"))], "doc_id", "source").select("tier", F.sha2("join_key", 256).alias("key_hash"), "doc_id", "source")


def uuid_sql(name: str) -> str:
    """SQL of the version 5 UUID of a text in the standard's namespace."""
    h = f"sha1(unhex('{observables.STANDARD.hex}') || encode({name}))"
    return f"(SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', h[17:17]), 1) || h[18:20] || '-' || h[21:32] FROM (SELECT {h} AS h))"


@query(f"""WITH f AS (SELECT o_orderkey, '10.' || (o_custkey % 80) || '.0.1' AS ip, 'n' || (o_custkey % 90) || '.example' AS name, 'https://n' || (o_custkey % 90) || '.example/' || (o_orderkey % 700) AS url FROM orders),
    v AS (SELECT 'ipv4-addr' AS kind, ip AS value, 'dest_ip' AS role, o_orderkey FROM f UNION ALL SELECT 'ipv6-addr', 'fe80::' || (o_orderkey % 9), 'src_ip', o_orderkey FROM f WHERE o_orderkey % 3 = 0
        UNION ALL SELECT 'ipv4-addr', '10.' || (o_orderkey % 50) || '.0.1', 'src_ip', o_orderkey FROM f WHERE o_orderkey % 3 = 1 UNION ALL SELECT 'domain-name', name, 'dest_fqdn', o_orderkey FROM f WHERE o_orderkey % 2 = 0
        UNION ALL SELECT 'url', url, 'url_full', o_orderkey FROM f WHERE o_orderkey % 5 = 0)
    SELECT kind, value, kind || '--' || {uuid_sql("'{\"value\":\"' || value || '\"}'")} AS id, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles, count(*) AS observations FROM v GROUP BY kind, value""")
def value_observables(spark, sf_dir):
    """Addresses, names and locators as observables with the standard's identities; what is no address is left out."""
    o = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    source = F.when(key % 3 == 0, text("FE80::", key % 9)).when(key % 3 == 1, text("10.", key % 50, ".0.1")).otherwise(F.lit("999.1.1.1"))
    rows = model_rows(
        o, F.lit("flow"), F.lit("message"), text("c", key), F.col("o_orderdate"),
        {"dest_ip": text("10.", customer % 80, ".0.1"), "src_ip": source, "dest_fqdn": F.when(key % 2 == 0, text("n", customer % 90, ".example")), "url_full": F.when(key % 5 == 0, text("https://n", customer % 90, ".example/", key % 700))}, {},
        row_id=text("c", key),
    )
    return observables.value_observables(rows).select("kind", "value", "id", F.array_join("roles", ",").alias("roles"), "observations")


@query(f"""WITH f AS (SELECT event_id, 'S-1-5-21-1-2-3-' || (user_id % 60) AS sid, 'n' || (event_id % 3) AS name FROM events WHERE event_id % 4 > 0)
    SELECT 'user-account--' || {uuid_sql("'{\"user_id\":\"' || sid || '\"}'")} AS id, sid AS user_id, arg_min(name, event_id) AS display_name, count(DISTINCT name) - 1 AS conflicts FROM f GROUP BY sid""")
def account_observables(spark, sf_dir):
    """Real accounts put together from all events that name them: the first name, and how many others there are."""
    e = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    rows = model_rows(
        e, F.lit("process"), F.lit("create"), F.concat(F.lit("p"), event), F.lit(None).cast("timestamp"), {"sid": F.when(event % 4 > 0, F.concat(F.lit("s-1-5-21-1-2-3-"), user % 60)), "user": F.concat(F.lit("n"), event % 3)}, {},
        row_id=F.lpad(event.cast("string"), 12, "0"),
    )
    upper = F.map_from_entries(F.transform(F.map_entries("props"), lambda x: F.struct(x["key"], F.when(x["key"] == "sid", F.upper(x["value"])).otherwise(x["value"]))))
    found = observables.accounts(rows.withColumn("props", upper), "c").where(F.map_contains_key("fields", "display_name"))
    of = lambda name: F.try_element_at("fields", F.lit(name))[0].alias(name)
    return found.select("id", of("user_id"), of("display_name"), F.coalesce(F.size(F.try_element_at("conflicts", F.lit("display_name"))), F.lit(0)).cast("long").alias("conflicts")).withColumn("conflicts", F.greatest("conflicts", F.lit(0).cast("long")))


@query(f"""WITH RECURSIVE d AS (SELECT doc_id, md5(text) AS m, sha256(text) AS s FROM documents)
    SELECT DISTINCT 'file--' || {uuid_sql("'{\"hashes\":{\"MD5\":\"' || m || '\"}}'")} AS id, m AS md5, s AS sha256 FROM d""")
def content_file_observables(spark, sf_dir):
    """The contents of files by all their hashes, some of which only some events have; the identity is over the MD5 one."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    both = model_rows(d, F.lit("file"), F.lit("create"), F.concat(F.lit("f"), doc), F.lit(None).cast("timestamp"), {"md5_hash": F.md5("text"), "sha256_hash": F.upper(F.sha2("text", 256))}, {}, row_id=F.concat(F.lit("f"), doc))
    one = model_rows(d.where("doc_id % 2 = 0"), F.lit("process"), F.lit("create"), F.concat(F.lit("p"), doc), F.lit(None).cast("timestamp"), {"sha256_hash": F.sha2("text", 256)}, {}, row_id=F.concat(F.lit("p"), doc))
    files, _ = observables.content_files(both.unionByName(one))
    of = lambda name: F.try_element_at("hashes", F.lit(name)).alias(name)
    return files.select("id", of("md5"), of("sha256"))


CASE_NAMESPACE = uuid.uuid5(ids.NAMESPACE, "case|c")


def case_sql(kind: str, key: str) -> str:
    """SQL of the case's identity of a thing of ``kind``, over its key."""
    return f"'{kind}--' || " + uuid_sql(key).replace(observables.STANDARD.hex, CASE_NAMESPACE.hex)


def exchanged_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files that processes of their customers' machines wrote, customers as those processes, of two images each."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    order, key, customer = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_custkey")
    none = F.lit(None).cast("string")
    files = model_rows(
        orders, F.lit("file"), F.lit("write"), F.concat(F.lit("f"), order), F.col("o_orderdate").cast("timestamp"),
        {"file_path": F.concat(F.lit("/d"), key % 20, F.lit("/x"), order % 300), "mime_type": F.col("o_orderpriority"), "pid": F.concat(F.lit("0x"), F.lower(F.hex(key))), "content": F.col("o_orderstatus")}, {},
        source_host=F.concat(F.lit("h"), key % 5), row_id=F.lpad(order.cast("string"), 12, "0"), owner_guid=F.concat(F.lit("p"), key), parent_guid=none, link_confidence=none,
    )
    processes = model_rows(
        customers, F.lit("process"), F.lit("create"), F.concat(F.lit("p"), customer), F.lit("1990-01-01").cast("timestamp"), {"image_path": F.concat(F.lit("/bin/i"), customer % 2), "command_line": F.col("c_name"), "env_vars": F.col("c_mktsegment")}, {},
        source_host=F.concat(F.lit("h"), customer % 5), row_id=F.concat(F.lit("c"), customer), owner_guid=none, parent_guid=none, link_confidence=none,
    )
    return files.unionByName(processes)


@query(f"""WITH f AS (SELECT 'h' || (o_custkey % 5) AS host, '/d' || (o_custkey % 20) || '/x' || (o_orderkey % 300) AS path, o_orderdate AS d, lpad(o_orderkey::VARCHAR, 12, '0') AS r, o_orderpriority AS m FROM orders),
    g AS (SELECT host, path, arg_min(m, (d, r)) AS mime_type, count(DISTINCT m) - 1 AS conflicts, regexp_replace(path, '/[^/]*$', '') AS folder FROM f GROUP BY host, path)
    SELECT {case_sql("file", "'file|' || host || '|path|' || path")} AS id, host, path AS x_path, regexp_extract(path, '[^/]*$') AS name, mime_type, conflicts, {case_sql("directory", "'directory|' || host || '|' || folder")} AS parent_directory_ref FROM g""")
def exchange_files(spark, sf_dir):
    """Files at paths, put together from all events that wrote them, with their folders."""
    made = exchange.objects(exchange.prepared(exchanged_case(spark, sf_dir), no_contents(spark)), "c").where("kind = 'file' AND map_contains_key(fields, 'mime_type')")
    of = lambda name, called=None: F.try_element_at("fields", F.lit(name))[0].alias(called or name)
    others = F.coalesce(F.try_element_at("conflicts", F.lit("mime_type")), F.array().cast("array<string>"))
    return made.select("id", of("x_source_host", "host"), of("x_path"), of("name"), of("mime_type"), F.size(others).cast("long").alias("conflicts"), of("parent_directory_ref"))


def no_contents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "node_id string, id string")


@query(f"""WITH f AS (SELECT 'h' || (o_custkey % 5) AS host, '/d' || (o_custkey % 20) || '/x' || (o_orderkey % 300) AS path, '/d' || (o_custkey % 20) AS folder, 'p' || o_custkey AS p, 'f' || o_orderkey AS guid, o_orderstatus AS s, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000000') AS t FROM orders),
    r AS (SELECT guid, {case_sql("observed-data", "'observed-data|s|' || host || '|file|' || guid || '|write|' || t || '||'")} AS id, s AS content, {case_sql("file", "'file|' || host || '|path|' || path")} AS a, {case_sql("directory", "'directory|' || host || '|' || folder")} AS b, {case_sql("process", "'process|' || host || '|' || p")} AS c FROM f)
    SELECT guid, id, content, array_to_string([a, b, c], ',') AS refs, c AS owner FROM r""")
def exchange_observations(spark, sf_dir):
    """Observations of files: what they refer to, in order, the process in its role, and what no thing took over."""
    seen = exchange.observations(exchange.prepared(exchanged_case(spark, sf_dir), no_contents(spark)), "c").where("car_object = 'file'")
    own = F.element_at(F.map_keys(F.map_filter("roles", lambda k, v: F.array_contains(v, "owning_guid"))), 1)
    return seen.select("guid", "id", F.try_element_at("fields", F.lit("content")).alias("content"), F.array_join("object_refs", ",").alias("refs"), own.alias("owner"))


@query(f"""WITH f AS (SELECT 'h' || (o_custkey % 5) AS host, '/d' || (o_custkey % 20) || '/x' || (o_orderkey % 300) AS path, 'p' || o_custkey AS p, o_orderkey, o_orderdate FROM orders),
    r AS (SELECT {case_sql("process", "'process|' || host || '|' || p")} AS s, {case_sql("file", "'file|' || host || '|path|' || path")} AS t, o_orderdate, o_orderkey FROM f),
    d AS (SELECT s, t, count(DISTINCT o_orderdate) AS n FROM r GROUP BY s, t)
    SELECT 'f' || o_orderkey AS guid, r.s AS source_ref, r.t AS target_ref, n AS relationships FROM r JOIN d USING (s, t)""")
def exchange_connected(spark, sf_dir):
    """The related pairs of things of each observation, and by how many relations; relations of one time are one."""
    rows = exchanged_case(spark, sf_dir)
    kinds = exchange.event_objects(rows)
    ready = exchange.prepared(rows, no_contents(spark), kinds, properties=False)
    seen = written(exchange.observations(ready, "c").select(*links.SCOPE, "car_object", "timestamp", "guid", "id", "object_refs"))
    wrote = written(build.edges(rows, kinds)).withColumns({c: F.lit(None).cast("string") for c in ("identity_key", "inferred_end", "corroborated_by")})
    related = exchange.relationships(wrote, exchange.ends(ready, seen, "c"), "c")
    # an observation goes by its event's identity, so that no second join brings it
    named = seen.select(F.col("guid").alias("id"), "object_refs")
    return exchange.connected(named, related).select(F.col("id").alias("guid"), "source_ref", "target_ref", "relationships")


@query("""SELECT 'e' || event_id AS guid, CASE WHEN event_id % 2 = 0 THEN 'd-' ELSE 'r-' END || event_type AS detection_id, CASE WHEN event_id % 2 = 0 THEN 'high' END AS severity, 'T10' || (10 + user_id % 80) AS techniques,
        CASE WHEN event_id % 2 = 0 THEN '10.0.0.' || (user_id % 250) END AS source_ip, CASE WHEN event_id % 2 = 0 THEN (event_id % 1000)::VARCHAR END AS port, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((extract(milliseconds FROM ts)::BIGINT % 1000)::VARCHAR, 3, '0') || 'Z' AS at
    FROM events WHERE event_type <> 'error'""")
def detection_hits(spark, sf_dir):
    """Hits of documents of two shapes, with dotted and nested names; documents that name no detection give none."""
    e = table(spark, sf_dir, "events")
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    at, technique = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), text("T10", user % 80 + 10)
    envelope = F.to_json(F.struct(F.when(kind != "error", text("d-", kind)).alias("DetectionId"), F.lit("HIGH").alias("Severity"), F.array(F.lower(technique)).alias("AttackIds"), at.alias("Timestamp"), text("10.0.0.", user % 250, " -> 10.1.0.1:", event % 1000).alias("Entity"), text("e", event).alias("RunId")))
    searched = F.to_json(F.struct(F.struct(F.when(kind != "error", text("r-", kind)).alias("id")).alias("rule"), F.array(technique, technique).alias("threat.technique.id"), at.alias("@timestamp"), F.struct(text("e", event).alias("id")).alias("event")))
    docs = e.select(F.lit("events").alias("path"), F.lit(None).cast("string").alias("index"), F.try_parse_json(F.when(event % 2 == 0, envelope).otherwise(searched)).alias("doc"))
    return hits.hits(docs).select(F.coalesce("guid", "run_id").alias("guid"), "detection_id", "severity", F.array_join("attack_ids", ",").alias("techniques"), "source_ip", F.col("destination_port").cast("string").alias("port"), "at")
