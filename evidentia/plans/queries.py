"""The engine's operators as queries over the test tables, each with the SQL that it must equal.

Events stand for tool records: user_id for a process id, signup for its creation, error for its end, other types for
what it did; a document's source stands for an evidence source and the hash of its text for a content hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.functions import ids, markers, times
from evidentia.operators import fold, graph, joins, projection, rules, verify
from evidentia.plans import maps
from evidentia.plans.model import ACTIONS
from evidentia.plans.tables import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.withColumns({c: F.col(c).cast("timestamp") for c, kind in rows.dtypes if kind == "timestamp_ntz"})


OBJECTS = {"signup": "process/create", "error": "process/terminate", "view": "file/read", "click": "http/get", "purchase": "flow/message"}
OBJECT_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in OBJECTS.items()) + " END"


def as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as rows of the event model."""
    kind = markers.map_value(F.col("event_type"), OBJECTS)
    rows = table(spark, sf_dir, "events").withColumn("_k", F.split(kind, "/")).where("_k IS NOT NULL")
    return rows.select(
        F.col("event_id").alias("seq"), "ts", "value", "props", "event_type", "user_id", F.col("_k")[0].alias("car_object"), F.col("_k")[1].alias("car_action"),
        F.concat(F.lit("host-"), F.col("user_id") % 7).alias("source_host"), ids.fields_guid("event", F.col("event_id")).alias("guid"),
    )


EVENTS_SQL = f"""ev AS (SELECT event_id AS seq, ts, value, props, event_type, user_id, split_part(o, '/', 1) AS car_object, split_part(o, '/', 2) AS car_action,
    'host-' || (user_id % 7) AS source_host, 'event-' || event_id AS guid FROM (SELECT *, {OBJECT_SQL} AS o FROM events) WHERE o IS NOT NULL)"""


@query(f"""WITH {EVENTS_SQL} SELECT guid, car_object, car_action, source_host, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at, json_extract_string(props, '$.k') AS k,
    CASE WHEN event_type IN ('signup', 'purchase') THEN upper(event_type) END AS level FROM ev""")
def map_project_events(spark, sf_dir):
    e = as_events(spark, sf_dir)
    level = markers.map_value(F.col("event_type"), {"signup": "SIGNUP", "purchase": "PURCHASE"})
    return e.select("guid", "car_object", "car_action", "source_host", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"), F.get_json_object("props", "$.k").alias("k"), level.alias("level"))


@query(r"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, nullif(regexp_extract(path, '([^/]*)$', 1), '') AS base, lower(nullif(regexp_extract(path, '([^/]*)$', 1), '')) AS low, nullif(split_part(host, '.', 1), '') AS label,
    replace(url, '://', '|') AS swapped, CASE WHEN regexp_matches(url, '/([a-z]{2})/') THEN regexp_extract(url, '/([a-z]{2})/', 1) END AS lang,
    'u@' || host AS mail, nullif(lower(host), '') AS mail_domain FROM p""")
def marker_strings_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract("url", "^([^?#]*)", 1).alias("path"))
    mail = markers.concat(F.lit("u@"), F.col("host"))
    return p.select(
        "page_id", markers.basename(F.col("path")).alias("base"), markers.lower(markers.basename(F.col("path"))).alias("low"), markers.host_label(F.col("host")).alias("label"),
        markers.replace(F.col("url"), "://", "|").alias("swapped"), markers.regex1(F.col("url"), "/([a-z]{2})/").alias("lang"), mail.alias("mail"), markers.domain_of(mail).alias("mail_domain"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS iso,
    ts < TIMESTAMP '2024-01-15 00:00:00' AS early, epoch_us(ts) // 1000000 AS whole FROM events""")
def marker_time_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = times.epoch_ts(F.unix_micros(F.col("ts")) / 1000000)
    return e.select("event_id", text.alias("iso"), times.ts_before(text, F.lit("2024-01-15T00:00:00Z")).alias("early"), F.floor(F.unix_micros("ts") / 1000000).alias("whole"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey AS number, l_suppkey & 1 <> 0 AS created, l_suppkey & 2 <> 0 AS deleted FROM lineitem""")
def hex_int_bits(spark, sf_dir):
    written = F.concat(F.lit("0x"), F.hex("l_partkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", markers.hex_int(written).alias("number"), markers.has_bit(F.col("l_suppkey"), 1).alias("created"), markers.has_bit(F.col("l_suppkey"), 2).alias("deleted"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1-%' THEN 'urgent' WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'large' END AS gate
    FROM orders WHERE o_orderpriority LIKE '1-%' OR (o_orderstatus = 'F' AND o_totalprice > 200000)""")
def gate_filter(spark, sf_dir):
    gate = F.when(F.col("o_orderpriority").startswith("1-"), "urgent").when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000), "large")
    return table(spark, sf_dir, "orders").select("o_orderkey", gate.alias("gate")).where("gate IS NOT NULL")


@query("""WITH c AS (SELECT c_nationkey, max(c_custkey) AS k FROM customer GROUP BY 1)
    SELECT o_orderkey, cu.c_custkey AS owner, coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END, ''), cu.c_mktsegment) AS segment
    FROM orders LEFT JOIN customer cu ON o_custkey = cu.c_custkey""")
def owner_guid_join(spark, sf_dir):
    spokes = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("").alias("segment"))
    made = table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_mktsegment").alias("segment")).alias("made"))
    linked = joins.lookup(spokes, made, {"o_custkey": "c_custkey"}, {"made": "made", "c_custkey": "owner"}, "c_custkey", last=True)
    return joins.inherit(linked, "made", {"segment": "segment"}).select("o_orderkey", "owner", "segment")


ASOF_SQL = f"""WITH {EVENTS_SQL}, made AS (SELECT user_id, ts, seq, guid,
        (SELECT min(x.ts) FROM ev x WHERE x.event_type = 'error' AND x.user_id = c.user_id AND x.ts > c.ts) AS ended FROM ev c WHERE event_type = 'signup'),
    pairs AS (SELECT s.guid, arg_max(m.guid, (m.ts, m.seq)) AS owning_guid FROM ev s JOIN made m ON s.user_id = m.user_id AND m.ts <= s.ts AND (m.ended IS NULL OR m.ended >= s.ts)
        WHERE s.event_type NOT IN ('signup', 'error') GROUP BY 1)"""


def owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = as_events(spark, sf_dir)
    both = e.where(F.col("event_type").isin("signup", "error"))
    # the next end of each creation, by one pass in falling time
    back = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.when(F.col("event_type") == "signup", 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    ends = both.withColumn("exit_ts", F.last(F.when(F.col("event_type") == "error", F.col("ts")), ignorenulls=True).over(back))
    creates = ends.where("event_type = 'signup'").select("user_id", "ts", "exit_ts", "guid", "seq")
    spokes = e.where(~F.col("event_type").isin("signup", "error")).select(F.col("guid").alias("row_id"), "user_id", "ts", "event_type", "value", "seq")
    return joins.owner_as_of(spokes, creates, ["user_id"])


@query(ASOF_SQL + " SELECT s.guid AS row_id, p.owning_guid FROM ev s LEFT JOIN pairs p USING (guid) WHERE s.event_type NOT IN ('signup', 'error')")
def owner_asof_join(spark, sf_dir):
    return owned(spark, sf_dir).select("row_id", "owning_guid")


@query("""SELECT c_custkey, n.n_name FROM (SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS host FROM customer) c
    LEFT JOIN (SELECT CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey END AS host, min(n_name) AS n_name FROM nation GROUP BY 1) n ON c.host IS NOT DISTINCT FROM n.host""")
def null_safe_host_join(spark, sf_dir):
    host = lambda c: F.when(F.col(c) % 5 != 0, F.col(c)).alias("host")
    left = table(spark, sf_dir, "customer").select("c_custkey", host("c_nationkey"))
    right = table(spark, sf_dir, "nation").select(host("n_nationkey"), "n_name")
    return joins.lookup(left, right, {"host": "host"}, {"n_name": "n_name"}, "n_name").select("c_custkey", "n_name")


@query(f"""WITH {EVENTS_SQL}, i AS (SELECT user_id, arg_min(guid, seq) AS first_login FROM ev WHERE event_type = 'signup' GROUP BY 1),
    o AS (SELECT user_id, arg_max(strftime(ts, '%Y-%m-%dT%H:%M:%S'), seq) AS session_end FROM ev WHERE event_type = 'error' GROUP BY 1)
    SELECT guid, session_end, NULL::VARCHAR AS login_guid FROM ev LEFT JOIN o USING (user_id) WHERE event_type = 'signup'
    UNION ALL SELECT guid, NULL, first_login FROM ev LEFT JOIN i USING (user_id) WHERE event_type = 'error'""")
def session_pairing(spark, sf_dir):
    e = as_events(spark, sf_dir).select("guid", "user_id", "seq", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    logins, logouts = joins.pair_sessions(e.where("event_type = 'signup'"), e.where("event_type = 'error'"), ["user_id"])
    return logins.select("guid", "session_end", F.lit(None).cast("string").alias("login_guid")).unionByName(logouts.select("guid", F.lit(None).cast("string").alias("session_end"), "login_guid"))


@query(r"""WITH d AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents),
    b AS (SELECT w, min(item_id) AS item_id FROM (SELECT item_id, unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE w <> '' GROUP BY 1),
    hits AS (SELECT doc_id, arg_min(item_id, pos) AS item_id FROM d JOIN b USING (w) GROUP BY 1)
    SELECT doc_id, hits.item_id FROM documents LEFT JOIN hits USING (doc_id)""")
def explode_first_match(spark, sf_dir):
    index = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", " ")).alias("w")).where("w <> ''")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return joins.first_match_in_list(rows, "doc_id", "words", index.withColumn("o", F.col("item_id")), "w", "item_id", "o").select("doc_id", "item_id")


@query("""SELECT p_partkey, f.first_guid, f.candidates FROM part LEFT JOIN (SELECT l_partkey, min(l_orderkey) AS first_guid, count(*) AS candidates FROM lineitem GROUP BY 1) f ON p_partkey = l_partkey""")
def path_equijoin_count(spark, sf_dir):
    found = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", F.col("l_orderkey").alias("o"))
    return joins.first_and_count(table(spark, sf_dir, "part").select("p_partkey"), found, {"p_partkey": "l_partkey"}, "l_orderkey", "o").select("p_partkey", "first_guid", "candidates")


@query("""WITH h AS (SELECT doc_id, source, sha256(text) AS hash FROM documents), r AS (SELECT hash, min(doc_id) AS other, count(*) AS n FROM h WHERE doc_id % 2 = 1 GROUP BY 1)
    SELECT doc_id, other FROM h JOIN r USING (hash) WHERE doc_id % 2 = 0 AND n = 1
    UNION ALL SELECT l.doc_id, min(x.doc_id) FROM h l JOIN r USING (hash) JOIN h x ON x.hash = l.hash AND x.doc_id % 2 = 1 AND x.source = l.source WHERE l.doc_id % 2 = 0 AND r.n > 1 GROUP BY 1 HAVING count(*) = 1""")
def link_one_to_one(spark, sf_dir):
    h = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("hash"))
    left = h.where("doc_id % 2 = 0").withColumnRenamed("source", "from_source")
    right = h.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "other")
    return joins.link_one_to_one(left, right, ["hash"], "doc_id", "other", F.col("from_source") == F.col("source"))


@query("""SELECT source, lang, list_sort(list(DISTINCT 'has_text')) AS rules, count(*) AS refs, min(doc_id) AS first_seen, max(doc_id) AS last_seen FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l JOIN documents o ON l.doc_id = o.doc_id WHERE l.toxic = 1 AND o.source = d.source AND o.lang = d.lang) GROUP BY 1, 2""")
def reconstruct_anti(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").withColumn("rule", F.lit("has_text"))
    seen = docs.join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id")
    return graph.reconstruct(docs, seen, ["source", "lang"], "rule", "doc_id").withColumnRenamed("references", "refs")


FOLD_SQL = f"""WITH {EVENTS_SQL}, f AS (SELECT source_host, car_object, user_id, car_action, strftime(ts, '%Y-%m-%d') AS day, seq, nullif(json_extract_string(props, '$.k'), '0') AS k, CAST(value AS DECIMAL(18, 2))::VARCHAR AS v, event_type FROM ev)"""


def to_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.nullif(F.get_json_object("props", "$.k"), F.lit("0"))
    return as_events(spark, sf_dir).select("source_host", "car_object", "user_id", "car_action", F.date_format("ts", "yyyy-MM-dd").alias("day"), "seq", k.alias("k"), F.col("value").cast("decimal(18,2)").cast("string").alias("v"), F.col("event_type").alias("source_artefact"))


FOLD_KEYS = ["source_host", "car_object", "user_id", "car_action", "day"]


@query(FOLD_SQL + """ SELECT source_host, car_object, user_id, car_action, day, min(seq) AS seq, arg_min(k, seq) FILTER (WHERE k <> '') AS k, arg_min(v, seq) FILTER (WHERE v <> '') AS v,
    count(*) AS contributions, list_sort(list(DISTINCT event_type)) AS contributed_by, count(DISTINCT k) > 1 AS k_differs FROM f GROUP BY ALL""")
def fold_additive(spark, sf_dir):
    out = fold.additive(to_fold(spark, sf_dir), FOLD_KEYS, guid="user_id")
    return out.select(*FOLD_KEYS, "seq", "k", "v", "contributions", "contributed_by", F.array_contains("conflicts", "k").alias("k_differs"))


@query(FOLD_SQL + """ SELECT source_host, car_object, user_id, car_action, day, b.seq AS seq, b.k AS k, b.v AS v FROM (
    SELECT source_host, car_object, user_id, car_action, day, arg_max({'seq': seq, 'k': k, 'v': v}, (CASE WHEN k <> '' THEN 1 ELSE 0 END, -seq)) AS b FROM f GROUP BY 1, 2, 3, 4, 5)""")
def fold_most_populated(spark, sf_dir):
    return fold.most_populated(to_fold(spark, sf_dir).drop("source_artefact"), FOLD_KEYS, guid="user_id")


@query("""SELECT hash, count(*) AS ref_count, min(doc_id) AS first_seen, max(doc_id) AS last_seen, list_sort(list(DISTINCT source))[1:64] AS source, list_sort(list(DISTINCT lang))[1:64] AS lang
    FROM (SELECT *, sha256(text) AS hash FROM documents) GROUP BY 1""")
def content_nodes(spark, sf_dir):
    return graph.content_nodes(table(spark, sf_dir, "documents").withColumn("hash", F.sha2("text", 256)), "hash", "doc_id", ["source", "lang"])


@query("""WITH k AS (SELECT doc_id, source, 1 AS rank, 'content' AS tier, sha256(text) AS join_key FROM documents WHERE text <> ''
        UNION ALL SELECT doc_id, source, 2, 'name', split_part(text, chr(10), 1) FROM documents WHERE split_part(text, chr(10), 1) <> ''),
    g AS (SELECT rank, tier, join_key, list_sort(list(DISTINCT source)) AS sources, list_sort(list(DISTINCT doc_id)) AS members FROM k GROUP BY 1, 2, 3 HAVING count(DISTINCT source) >= 2)
    SELECT tier, join_key, sources, members FROM g QUALIFY row_number() OVER (PARTITION BY members ORDER BY rank, join_key) = 1""")
def converge_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("text") != "", F.sha2("text", 256)).alias("h"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("line"))
    return graph.converge(docs, [("content", F.col("h")), ("name", F.col("line"))], "doc_id", "source")


@query("""WITH u AS (SELECT sha256(text) AS hash, doc_id, unnest(['lang', 'source']) AS property, unnest([lang, source]) AS value FROM documents)
    SELECT hash, property, arg_min(value, doc_id) AS value, count(DISTINCT value) - 1 AS conflicts FROM u WHERE value <> '' GROUP BY 1, 2""")
def merge_properties(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("hash"))
    return graph.merged_properties(docs, "hash", ["lang", "source"], "doc_id")


EDGES_SQL = """e AS (SELECT 'placed' AS relationship, 'customer' AS source_object, o_custkey::VARCHAR AS source_guid, 'order' AS target_object, o_orderkey::VARCHAR AS target_guid, o_orderdate AS timestamp FROM orders
    UNION ALL SELECT 'flagged', 'customer', o_custkey::VARCHAR, 'order', o_orderkey::VARCHAR, o_orderdate FROM orders WHERE o_orderpriority LIKE '1-%'
    UNION ALL SELECT 'closed', 'order', o_orderkey::VARCHAR, 'status', o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F')"""


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, customer, order = F.col("o_orderdate"), ("customer", F.col("o_custkey")), ("order", F.col("o_orderkey"))
    kinds = [
        graph.edge(F.lit("placed"), customer, order, F.lit(True), at),
        graph.edge(F.lit("flagged"), customer, order, F.col("o_orderpriority").startswith("1-"), at),
        graph.edge(F.lit("closed"), order, ("status", F.col("o_orderstatus")), F.col("o_orderstatus") == "F", at),
    ]
    return graph.edges(table(spark, sf_dir, "orders"), kinds)


@query(f"WITH {EDGES_SQL} SELECT relationship, source_object, source_guid, target_object, target_guid, strftime(timestamp, '%Y-%m-%d') AS day FROM e")
def edges_union(spark, sf_dir):
    return order_edges(spark, sf_dir).select("relationship", "source_object", "source_guid", "target_object", "target_guid", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))


#: Every action of every object, and, as SQL of its own, the verb of an edge to it.
PAIRS = [f"{kind}/{action}" for kind, actions in ACTIONS.items() for action in actions]
VERB_SQL = """CASE
    WHEN pair IN ('file/create', 'registry/add', 'registry/create', 'service/create', 'thread/create', 'thread/remote_create', 'http/get', 'http/post', 'http/put', 'user_session/login', 'user_session/reconnect', 'user_session/create', 'email/deliver') THEN 'created'
    WHEN pair IN ('file/write', 'file/modify', 'file/acl_modify', 'file/timestomp', 'registry/value_edit', 'registry/key_edit', 'registry/modify', 'service/modify', 'service/pause', 'email/redirect') THEN 'modified'
    WHEN pair IN ('file/delete', 'registry/remove', 'registry/delete', 'service/delete', 'email/delete') THEN 'deleted'
    WHEN pair IN ('file/content', 'file/metadata', 'module/content', 'module/metadata', 'driver/metadata', 'service/metadata', 'user_session/metadata') THEN 'retrieved information about'
    WHEN pair IN ('module/load', 'driver/load') THEN 'loaded'
    WHEN pair IN ('module/unload', 'driver/unload') THEN 'unloaded'
    WHEN pair IN ('flow/start', 'flow/message', 'flow/end', 'flow/create', 'flow/content', 'flow/flow', 'http/tunnel') THEN 'connected to'
    WHEN pair IN ('service/stop', 'email/block') THEN 'stopped'
    WHEN pair IN ('service/start') THEN 'started'
    WHEN pair IN ('service/enumerate') THEN 'listed'
    WHEN pair IN ('thread/terminate', 'socket/close', 'user_session/logout', 'user_session/terminate') THEN 'terminated'
    WHEN pair IN ('socket/bind') THEN 'bound to'
    WHEN pair IN ('socket/listen') THEN 'listened on'
    WHEN pair IN ('user_session/unlock') THEN 'unlocked'
    WHEN pair IN ('user_session/lock', 'email/quarantine') THEN 'locked'
    WHEN pair IN ('authentication/success', 'authentication/failure', 'authentication/error') THEN 'requested'
    ELSE 'accessed' END"""


@query(f"""WITH p AS (SELECT event_id, list_extract({PAIRS}, (event_id % {len(PAIRS)} + 1)::INTEGER) AS pair FROM events) SELECT event_id, pair, {VERB_SQL} AS verb FROM p""")
def edge_verbs(spark, sf_dir):
    pair = F.element_at(F.array(*map(F.lit, PAIRS)), (F.col("event_id") % len(PAIRS) + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", pair.alias("pair"))
    return rows.withColumn("verb", graph.verb_of(F.split_part("pair", F.lit("/"), F.lit(1)), F.split_part("pair", F.lit("/"), F.lit(2))))


@query(f"""WITH {EDGES_SQL}, x AS (SELECT source_guid AS entity, 'out' AS direction, target_guid AS other, relationship FROM e WHERE source_guid <> ''
    UNION ALL SELECT target_guid, 'in', source_guid, relationship FROM e WHERE target_guid <> '') SELECT * FROM x""")
def edge_lookup_fanout(spark, sf_dir):
    return graph.lookup_fanout(order_edges(spark, sf_dir))


@query(f"""WITH {EVENTS_SQL} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, 'object' AS kind, car_object AS object, source_host AS host, guid, car_action AS detail FROM ev WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND source_host = 'host-3'
    UNION ALL SELECT strftime(ts, '%Y-%m-%d %H:%M:%S'), 'relationship', car_object, source_host, guid, 'accessed' FROM ev WHERE car_object = 'file' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND source_host = 'host-3'""")
def timeline_merge(spark, sf_dir):
    e = as_events(spark, sf_dir).select("ts", F.col("car_object").alias("object"), F.col("source_host").alias("host"), "guid", F.col("car_action").alias("detail"))
    out = graph.timeline([("object", e), ("relationship", e.where("object = 'file'").withColumn("detail", F.lit("accessed")))], "host-3", "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT 'documents' AS "table", 'rows' AS "check", count(*) AS n, true AS passed FROM documents
    UNION ALL SELECT 'documents', 'without source', count(*) FILTER (WHERE source IS NULL OR trim(source) = ''), count(*) FILTER (WHERE source IS NULL OR trim(source) = '') = 0 FROM documents
    UNION ALL SELECT 'orders', 'priced', count(*) FILTER (WHERE o_totalprice > 0), count(*) FILTER (WHERE o_totalprice > 0) >= 1 FROM orders""")
def verify_counts(spark, sf_dir):
    docs = verify.checked("documents", table(spark, sf_dir, "documents"), {"rows": (F.lit(True), "ge", 1), "without source": (F.col("source").isNull() | (F.trim("source") == ""), "eq", 0)})
    return docs.unionByName(verify.checked("orders", table(spark, sf_dir, "orders"), {"priced": (F.col("o_totalprice") > 0, "ge", 1)}))


CAR_RULES = {
    "promo": 'p_type == "PROMO*" and not p_size < 10',
    "brand": "p_brand in [Brand#13, Brand#24] or (p_size >= 45 and p_retailprice > 1500)",
    "match": 'p_name match "(red|blue)" and p_type != "*BRASS"',
}


@query("""SELECT p_partkey, 'promo' AS rule FROM part WHERE lower(p_type) LIKE 'promo%' AND NOT p_size < 10
    UNION ALL SELECT p_partkey, 'brand' FROM part WHERE lower(p_brand) IN ('brand#13', 'brand#24') OR (p_size >= 45 AND p_retailprice > 1500)
    UNION ALL SELECT p_partkey, 'match' FROM part WHERE regexp_matches(p_name, '(?i)(red|blue)') AND NOT lower(p_type) LIKE '%brass'""")
def car_rule_hits(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    resolve = rules.fields_of(part)
    return rules.hits(part, {k: rules.compile_filter(t, resolve) for k, t in CAR_RULES.items()}, ["p_partkey"])


SIGMA_RULES = {
    "secrets": {"sel_key": {"text|contains": ["api_key", "password"]}, "sel_aws": {"text|re": "AKIA[0-9A-Z]{16}"}, "other": {"lang": "de"}, "condition": "1 of sel_* and not other"},
    "both": {"a": {"text|contains|all": ["the", "and"], "source|endswith": "1"}, "b": {"lang|startswith": "e"}, "condition": "all of them"},
}


@query(r"""SELECT doc_id, 'secrets' AS rule FROM documents WHERE (contains(lower(text), 'api_key') OR contains(lower(text), 'password') OR regexp_matches(text, '(?i)AKIA[0-9A-Z]{16}')) AND NOT lower(lang) = 'de'
    UNION ALL SELECT doc_id, 'both' FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'and') AND lower(source) LIKE '%1' AND lower(lang) LIKE 'e%'""")
def sigma_rule_hits(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    resolve = rules.fields_of(docs)
    return rules.hits(docs, {k: rules.compile_sigma(d, resolve) for k, d in SIGMA_RULES.items()}, ["doc_id"])


@query(r"""SELECT host, count(*) AS queries, max(length(url)) AS longest, min(length(url)) AS shortest FROM (SELECT url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)
    WHERE length(url) > 40 AND host LIKE '%.example.%' GROUP BY 1 ORDER BY queries DESC, host LIMIT 10""")
def dns_oversized_topk(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host")).where((F.length("url") > 40) & F.col("host").contains(".example."))
    return p.groupBy("host").agg(F.count("*").alias("queries"), F.max(F.length("url")).cast("long").alias("longest"), F.min(F.length("url")).cast("long").alias("shortest")).orderBy(F.desc("queries"), "host").limit(10)


@query("""SELECT sha1('event|' || event_id || '|' || coalesce(props, '')) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || strftime(ts, '.%g') || 'Z' AS at, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN TRY_CAST(event_type AS BIGINT) IS NULL THEN event_type END AS overflow, event_type || '|user-' || user_id AS related,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 1.0 ELSE 0.5 END AS confidence FROM events""")
def ecs_project(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k, overflow = projection.coerced("long", F.col("event_type"), F.get_json_object("props", "$.k"))
    rel = projection.related(F.col("event_type"), F.concat(F.lit("user-"), F.col("user_id")))
    word = F.when(F.col("event_type").isin("signup", "purchase"), "definitive").otherwise("heuristic")
    return e.select(ids.document_id(F.lit("event"), F.col("event_id"), F.col("props")).alias("id"), times.iso_z(F.col("ts")).alias("at"), k.alias("k"), overflow.alias("overflow"), F.array_join(rel, "|").alias("related"), projection.confidence(word).alias("confidence"))


@query("""WITH c AS (SELECT event_id, c_custkey, 0 AS prio FROM events JOIN customer ON user_id = c_custkey AND value > 50
        UNION ALL SELECT event_id, c_custkey, 1 FROM events JOIN customer ON user_id = c_custkey
        UNION ALL SELECT event_id, n_nationkey, 2 FROM events JOIN nation ON user_id % 25 = n_nationkey)
    SELECT event_id, c_custkey AS entity, prio FROM c QUALIFY prio = min(prio) OVER (PARTITION BY event_id)""")
def detection_priority_match(spark, sf_dir):
    e, c, n = (table(spark, sf_dir, t) for t in ("events", "customer", "nation"))
    own = e.join(c, e["user_id"] == c["c_custkey"])
    ways = [own.where("value > 50"), own, e.join(n, F.col("user_id") % 25 == F.col("n_nationkey")).withColumn("c_custkey", F.col("n_nationkey").cast("long"))]
    return joins.priority_match([w.select("event_id", F.col("c_custkey").alias("entity")) for w in ways], "event_id")


@query("""WITH i AS (SELECT 'name' AS kind, p_brand AS value, min(p_partkey) % 3 AS score FROM part GROUP BY p_brand UNION ALL SELECT 'type', p_type, min(p_partkey) % 5 FROM part GROUP BY p_type)
    SELECT p_partkey, kind, 'p_brand' AS field, value, score FROM part JOIN i ON kind = 'name' AND p_brand = value UNION ALL SELECT p_partkey, kind, 'p_type', value, score FROM part JOIN i ON kind = 'type' AND p_type = value""")
def indicator_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    of = lambda kind, c, n: part.groupBy(F.col(c).alias("value")).agg((F.min("p_partkey") % n).alias("score")).select(F.lit(kind).alias("kind"), "value", "score")
    found = joins.any_field_match(part, "p_partkey", {"name": ["p_brand"], "type": ["p_type"]}, of("name", "p_brand", 3).unionByName(of("type", "p_type", 5)))
    return found.select("p_partkey", "kind", "field", "value", "score")


@query(f"""WITH h AS (SELECT o_orderkey, sha1(unhex('{ids.NAMESPACE.hex}') || encode('{{"_obj":"order","_v":1,"customer":"' || o_custkey || '","key":"' || o_orderkey || '"}}')) AS h FROM orders)
    SELECT o_orderkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', h[17:17]), 1) || h[18:20] || '-' || h[21:32] AS guid FROM h""")
def spindle_uuid5(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", ids.minted("order", 1, {"key": F.col("o_orderkey"), "customer": F.col("o_custkey")}).alias("guid"))


@query("""SELECT p_partkey, lower(printf('%02x:1b:%02x:00:aa:0f', (p_partkey % 128) * 2, p_size)) AS mac, 'T1' || lpad((p_partkey % 900)::VARCHAR, 3, '0') || '.001' AS technique, 'SER' || p_partkey AS serial,
    '0a1b2c3d-0000-4000-8000-' || lpad(p_partkey::VARCHAR, 12, '0') AS volume FROM part""")
def native_id_extract(spark, sf_dir):
    """Identifiers that texts of tools name: addresses (a multicast one is left out), techniques, serials, volumes."""
    two = lambda c: F.lpad(F.hex(c), 2, "0")
    said = F.concat(F.lit("adapter "), two((F.col("p_partkey") % 128) * 2), F.lit("-1B-"), two(F.col("p_size")), F.lit("-00-AA-0F and 01-00-5E-00-00-01, by t1"), F.lpad(F.col("p_partkey") % 900, 3, "0"), F.lit("_001 on USBSTOR#Disk&Ven_X&Prod_Y#ser"), F.col("p_partkey"), F.lit("&0 of Volume{0A1B2C3D-0000-4000-8000-"), F.lpad(F.col("p_partkey"), 12, "0"), F.lit("}"))
    text = table(spark, sf_dir, "part").select("p_partkey", said.alias("t"))
    found = {"mac": ids.mac_addresses, "technique": ids.technique_ids, "serial": ids.usb_serials, "volume": ids.volume_guids}
    return text.select("p_partkey", *(ids.native_first(f(F.col("t"))).alias(k) for k, f in found.items()))


@query("""SELECT conv_id, turn, role, length(text) AS size FROM conversations""")
def jumplist_explode(spark, sf_dir):
    nested = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("entries"))
    return nested.select("conv_id", F.explode("entries").alias("e")).select("conv_id", "e.turn", "e.role", F.length("e.text").cast("long").alias("size"))


@query("""WITH RECURSIVE h AS (SELECT doc_id AS id, sha256(text) AS k FROM documents), l AS (SELECT a.id AS a, min(b.id) AS b FROM h a JOIN h b USING (k) GROUP BY 1)
    SELECT a AS id, b AS component FROM l""")
def components(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("k"))
    star = docs.groupBy("k").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = docs.join(star, "k").where("id <> a").select("a", F.col("id").alias("b"))
    return graph.components(docs, links, written)


@query("""SELECT n_name, list_sort(list(DISTINCT s_suppkey)) AS suppliers, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def host_reconcile(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).groupBy("n_name").agg(F.array_sort(F.collect_set("s_suppkey")).alias("suppliers"), F.count("*").alias("n"))


@query(ASOF_SQL + """, o AS (SELECT s.user_id, s.event_type, p.owning_guid, s.value, s.seq FROM ev s LEFT JOIN pairs p USING (guid) WHERE s.event_type NOT IN ('signup', 'error'))
    SELECT event_type, owning_guid IS NOT NULL AS owned, count(*) AS n, count(DISTINCT owning_guid) AS owners, round(sum(value), 2) AS total FROM o GROUP BY 1, 2""")
def flagship(spark, sf_dir):
    """What processes did, by whether their owner is known."""
    return owned(spark, sf_dir).groupBy("event_type", F.col("owning_guid").isNotNull().alias("owned")).agg(F.count("*").alias("n"), F.count_distinct("owning_guid").alias("owners"), F.round(F.sum("value"), 2).alias("total"))


def as_records(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Rows as raw tool records: JSON lines, parsed as a scan would, dealt over the cores as the splits of such files would be."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism).select(F.try_parse_json(F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))).alias("record"))


@query("""SELECT 'authentication-host' || (user_id % 7) || '.example-Security-' || event_id AS guid, CASE event_type WHEN 'signup' THEN 'success' ELSE 'failure' END AS action,
    'host' || (user_id % 7) AS host, 'user' || user_id AS target_user, CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') END AS reason
    FROM events WHERE event_type IN ('signup', 'error')""")
def evtx_security_map(spark, sf_dir):
    """Security records made of events, through the scan's parser and the map of the channel."""
    e = table(spark, sf_dir, "events")
    named = lambda k, v: F.struct(F.lit(k).alias("@Name"), v.cast("string").alias("#text"))
    body = F.array(named("TargetUserName", F.concat(F.lit("user"), F.col("user_id"))), named("Status", F.get_json_object("props", "$.k")))
    records = as_records(e, {
        "EventId": F.when(F.col("event_type") == "signup", 4624).when(F.col("event_type") == "error", 4625).otherwise(1), "Channel": F.lit("Security"), "Computer": F.concat(F.lit("host"), F.col("user_id") % 7, F.lit(".example")),
        "EventRecordId": F.col("event_id"), "TimeCreated": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "Payload": F.to_json(F.struct(F.struct(body.alias("Data")).alias("EventData"))),
    })
    rows = maps.widened(maps.apply(records, {"evtx_security": maps.MAPS["evtx_security"]}), "authentication")
    return rows.select("guid", F.col("car_action").alias("action"), F.col("source_host").alias("host"), "target_user", F.col("decision_reason").alias("reason"))


@query("""SELECT 'C' || o_orderkey AS guid, CASE o_orderstatus WHEN 'F' THEN 'end' WHEN 'O' THEN 'start' ELSE 'message' END AS action, '10.0.' || (o_custkey % 250) || '.1' AS src_ip,
    'dom' || (o_custkey % 11) || '.example' AS dest_fqdn, o_custkey % 100 + o_orderkey % 10 AS packets FROM orders""")
def zeek_flows(spark, sf_dir):
    """Connections with the names that TLS records of the same connection give them."""
    o = table(spark, sf_dir, "orders")
    five = {"uid": F.concat(F.lit("C"), F.col("o_orderkey")), "ts": F.unix_seconds("o_orderdate"), "id.orig_h": F.concat(F.lit("10.0."), F.col("o_custkey") % 250, F.lit(".1"))}
    state = F.when(F.col("o_orderstatus") == "F", "SF").when(F.col("o_orderstatus") == "O", "S0").otherwise("OTH")
    conn = as_records(o, five | {"conn_state": state, "orig_pkts": F.col("o_custkey") % 100, "resp_pkts": F.col("o_orderkey") % 10})
    tls = as_records(o, five | {"version": F.lit("TLSv13"), "server_name": F.concat(F.lit("dom"), F.col("o_custkey") % 11, F.lit(".example"))})
    flows = maps.widened(maps.apply(conn, {"zeek_conn": maps.MAPS["zeek_conn"]}), "flow").drop("dest_fqdn")
    names = maps.widened(maps.apply(tls, {"zeek_ssl": maps.MAPS["zeek_ssl"]}), "flow").select("guid", "dest_fqdn", "timestamp")
    out = joins.lookup(flows, names, {"guid": "guid"}, {"dest_fqdn": "dest_fqdn"}, "timestamp")
    return out.select("guid", F.col("car_action").alias("action"), "src_ip", "dest_fqdn", F.col("packet_count").cast("bigint").alias("packets"))


def log_record(e: DataFrame, number: Column, channel: str, body: Column) -> DataFrame:
    return as_records(e, {
        "EventId": number, "Channel": F.lit(channel), "Computer": F.concat(F.lit("host"), F.col("user_id") % 7, F.lit(".example")), "EventRecordId": F.col("event_id"),
        "TimeCreated": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "Payload": body,
    })


def data_list(**values: Column) -> Column:
    return F.to_json(F.struct(F.struct(F.array(*(F.struct(F.lit(k).alias("@Name"), v.cast("string").alias("#text")) for k, v in values.items())).alias("Data")).alias("EventData")))


def user_data(**values: Column) -> Column:
    return F.to_json(F.struct(F.struct(F.struct(*(v.cast("string").alias(k) for k, v in values.items())).alias("EventXML")).alias("UserData")))


@query(r"""SELECT 'http' AS object, 'get' AS action, 'http-host' || (user_id % 7) || '.example-Microsoft-Windows-Bits-Client/Operational-' || event_id AS guid, 'dom' || (user_id % 5) || '.example' AS subject, '/f?' || event_id AS detail FROM events WHERE event_type IN ('view', 'click')
    UNION ALL SELECT 'user_session', CASE event_type WHEN 'signup' THEN 'login' WHEN 'error' THEN 'logout' ELSE 'reconnect' END, 'user_session-host' || (user_id % 7) || '.example-Microsoft-Windows-TerminalServices-LocalSessionManager/Operational-' || event_id,
        CASE user_id % 3 WHEN 0 THEN 'SYSTEM' WHEN 1 THEN 'CORP\u' || user_id ELSE 'u' || user_id END, CASE WHEN event_type <> 'error' THEN '10.0.0.' || (user_id % 250) END FROM events WHERE event_type IN ('signup', 'error', 'purchase')
    UNION ALL SELECT 'user_session', CASE event_type WHEN 'view' THEN 'login' ELSE 'logout' END, 'user_session-host' || (user_id % 7) || '.example-System-' || event_id, 'S-1-5-21-' || user_id, NULL FROM events WHERE event_type IN ('view', 'click')
    UNION ALL SELECT 'service', 'stop', 'service-host' || (user_id % 7) || '.example-System-' || event_id, 'svc' || user_id, NULL FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'service', 'create', 'service-host' || (user_id % 7) || '.example-System-' || event_id, 'drv' || user_id, 'd' || user_id || '.sys' FROM events WHERE event_type = 'signup'
    UNION ALL SELECT 'file', 'acl_modify', 'file-host' || (user_id % 7) || '.example-Security-' || event_id, 'C:\d\f' || user_id || '.TXT', 'txt' FROM events WHERE event_type = 'purchase'""")
def evtx_channels_map(spark, sf_dir):
    """Records of further channels: transfers, remote sessions, logons, services, changed descriptors."""
    e = table(spark, sf_dir, "events")
    kind, user = F.col("event_type"), F.col("user_id")
    of = lambda table: F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), kind)
    transfer = data_list(url=F.concat(F.lit("https://dom"), user % 5, F.lit(".example/f?"), F.col("event_id")))
    name = F.when(user % 3 == 0, "S-1-5-18").when(user % 3 == 1, F.concat(F.lit("CORP\\u"), user)).otherwise(F.concat(F.lit("u"), user))
    session = user_data(User=name, Address=F.when(kind == "error", "LOCAL").otherwise(F.concat(F.lit("10.0.0."), user % 250)))
    system = F.when(kind == "error", data_list(param1=F.concat(F.lit("svc"), user))).when(kind == "signup", user_data(ServiceName=F.concat(F.lit("drv"), user), DriverFileName=F.concat(F.lit("C:\\w\\d"), user, F.lit(".sys")))).otherwise(data_list(UserSid=F.concat(F.lit("S-1-5-21-"), user)))
    changed = data_list(ObjectType=F.when(kind == "purchase", "File").otherwise("Key"), ObjectName=F.concat(F.lit("C:\\d\\f"), user, F.lit(".TXT")))
    records = [
        log_record(e, of({"view": 59, "click": 60, "signup": 61, "error": 3, "purchase": 4}), "Microsoft-Windows-Bits-Client/Operational", transfer),
        log_record(e, of({"signup": 21, "error": 24, "purchase": 25, "view": 40, "click": 41}), "Microsoft-Windows-TerminalServices-LocalSessionManager/Operational", session),
        log_record(e, of({"view": 7001, "click": 7002, "error": 7034, "signup": 20003, "purchase": 1}), "System", system),
        log_record(e, F.lit(4907), "Security", changed),
    ]
    events = maps.apply(records[0].unionByName(records[1]).unionByName(records[2]).unionByName(records[3]), {m: maps.MAPS[m] for m in ("evtx_bits", "evtx_rdp", "evtx_more")})
    prop = lambda k: F.try_element_at("props", F.lit(k))
    subject = F.coalesce(prop("url_domain"), prop("user"), prop("uid"), prop("name"), prop("file_path"))
    return events.select(F.col("car_object").alias("object"), F.col("car_action").alias("action"), "guid", subject.alias("subject"), F.coalesce(prop("url_remainder"), prop("src_ip"), prop("exe"), prop("extension")).alias("detail"))


@query("""SELECT o_orderkey AS k, 'file' AS object, CASE o_orderkey % 5 WHEN 0 THEN 'create' WHEN 1 THEN 'modify' WHEN 2 THEN 'read' ELSE 'delete' END AS action, '/d/f' || o_orderkey || '.Tar' AS path, 'tar' AS extension, o_orderkey % 5 = 0 AS created FROM orders WHERE o_orderkey % 5 < 4
    UNION ALL SELECT o_orderkey, 'file', CASE WHEN o_custkey % 4 IN (1, 3) THEN 'create' WHEN o_custkey % 4 = 2 THEN 'delete' ELSE 'modify' END, 'j' || o_orderkey, NULL, o_custkey % 4 IN (1, 3) FROM orders
    UNION ALL SELECT o_orderkey, 'user_session', CASE WHEN o_orderkey % 10 = 8 THEN 'logout' ELSE 'login' END, NULL, NULL, false FROM orders WHERE o_orderkey % 10 IN (6, 7, 8)
    UNION ALL SELECT o_orderkey, 'user_session', 'login', NULL, NULL, false FROM orders WHERE o_custkey % 2 = 0""")
def timeline_rows_map(spark, sf_dir):
    """Wrapped rows of a disk image's timeline: file times, a change journal, logins."""
    o = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    wrapped = lambda **record: as_records(o, {"SourceImage": F.lit("i"), "Timestamp": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "Record": F.struct(*(v.alias(k) for k, v in ({"k": key.cast("string")} | record).items()))})
    stamps = F.element_at(F.array(*(F.lit(x) for x in ("Creation Time", "Content Modification Time", "Last Access Time", "Deletion Time", "Added Time"))), (key % 5 + 1).cast("int"))
    sources = {
        "l2t_filestat": wrapped(display_name=F.concat(F.lit("TSK:/d/f"), key, F.lit(".Tar")), timestamp_desc=stamps, number_of_links=key),
        "l2t_usnjrnl": wrapped(filename=F.concat(F.lit("j"), key), update_reason_flags=(customer % 4) * 256, update_sequence_number=key, file_reference=customer, number_of_links=key),
        "l2t_utmp": wrapped(login_type=key % 10, terminal=key.cast("string")), "l2t_text": wrapped(data_type=F.when(customer % 2 == 0, "syslog:ssh:login").otherwise("syslog:line"), reporter=key.cast("string")),
    }
    native = {"l2t_filestat": "number_of_links", "l2t_usnjrnl": "update_sequence_number", "l2t_utmp": "terminal", "l2t_text": "reporter"}
    prop = lambda k: F.try_element_at("props", F.lit(k))
    out = [
        maps.apply(rows, {name: maps.MAPS[name]}).select(F.try_element_at("native", F.lit(native[name])).cast("bigint").alias("k"), F.col("car_object").alias("object"), F.col("car_action").alias("action"), prop("file_path").alias("path"), prop("extension").alias("extension"), prop("creation_time").isNotNull().alias("created"))
        for name, rows in sources.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
