"""Links between the events of one source: owners, parents, connections, names, sessions, certificates, executed files.

Each kind of link looks rows up among the others and gives facts: (row_id, stage, columns, props, native). ``with_facts`` adds
all facts of a row in one join: columns and props are filled where the row has none, the first stage first; native entries are
put. A row has at most one fact of a stage, so nothing that is collected grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions.blanks import present
from evidentia.functions.markers import WELL_KNOWN_SIDS, hex_int, user_canon
from evidentia.operators import joins
from evidentia.plans.model import FIELDS, FLOW_INHERITS, OWNER_INHERITS, PARENT_INHERITS

#: Every key of a link starts with these: the sources of a case, and their hosts, stay apart.
SCOPE = ["source", "source_host"]
BAG = "map<string,string>"
DEFINITIVE, HEURISTIC = "definitive", "heuristic"
#: Sessions that recur in every boot, the one that names none, and renderings of well-known accounts.
WELL_KNOWN_LUIDS = ["0x3e4", "0x3e5", "0x3e7"]
NULL_LUIDS = ["0x0"]
OPENING, CLOSING = ["login", "reconnect", "unlock"], ["logout", "disconnect"]
ALIASES = ["system", "local system", "localsystem", "systemprofile", "nt authority", "local service", "localservice", "network service", "networkservice"]
#: The accounts that a row's identifier names when its user is blank or one of the renderings.
NAMED_SIDS = ["S-1-5-18", "S-1-5-19", "S-1-5-20"]


def prop(name: str) -> Column:
    return F.try_element_at("props", F.lit(name))


def native(name: str) -> Column:
    return F.try_element_at("native", F.lit(name))


def known(values: Mapping[str, Column]) -> Column:
    """A bag of the values that there are."""
    if not values:
        return F.create_map().cast(BAG)
    return F.map_filter(F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v.cast("string")))), lambda k, v: v.isNotNull())


def put(bag: Column, more: Column) -> Column:
    """``bag`` with the entries of ``more``, which replace its own."""
    return F.map_concat(F.map_filter(bag, lambda k, v: ~F.map_contains_key(more, k)), more)


def facts(rows: DataFrame, stage: int, columns: Mapping[str, Column] | None = None, props: Mapping[str, Column] | None = None, evidence: Mapping[str, Column] | None = None) -> DataFrame:
    return rows.select("row_id", F.lit(stage).alias("stage"), known(columns or {}).alias("columns"), known(props or {}).alias("fill"), known(evidence or {}).alias("evidence"))


def order() -> Column:
    """Of several rows the first, or last, is that of the smallest, or largest, time and identity."""
    return F.struct("timestamp", "row_id")


def canonical(rows: DataFrame) -> DataFrame:
    """Account names as they are told everywhere: well-known ones by their identifier where the name is blank or a rendering."""
    has_user = F.col("car_object").isin([k for k, fields in FIELDS.items() if "user" in fields])
    sid = F.coalesce(present(prop("sid")), present(prop("uid")))
    named = F.try_element_at(F.create_map(*(F.lit(x) for k in NAMED_SIDS for x in (k, WELL_KNOWN_SIDS[k]))), sid)
    loose = present(prop("user")).isNull() | F.lower(F.trim(prop("user"))).isin(ALIASES)
    user = F.when(has_user & named.isNotNull() & loose, named).otherwise(user_canon(prop("user")))
    return rows.withColumn("props", put(F.col("props"), known({"user": user})))


def lifted(rows: DataFrame) -> DataFrame:
    """The first volume, address and device that a row's native values name, as columns of their own."""
    text = F.array_join(F.map_values("native"), "\n")
    found = {"volume_guid": ids.volume_guids(text), "mac_address": ids.mac_addresses(text), "device_serial": ids.usb_serials(text)}
    return rows.withColumns({k: ids.native_first(v) for k, v in found.items()})


def processes(rows: DataFrame) -> DataFrame:
    """Creations of processes, with the first time at which their identity ended."""
    process = rows.where("car_object = 'process'")
    exits = process.where("car_action IN ('terminate', 'exit') AND guid IS NOT NULL").groupBy(*SCOPE, "guid").agg(F.min("ts").alias("exit_ts"))
    creates = process.where("car_action = 'create'").select(*SCOPE, "guid", "ts", "timestamp", "row_id", "props", "native", hex_int(prop("pid")).alias("pid"))
    return joins.lookup(creates, exits, {k: k for k in (*SCOPE, "guid")}, {"exit_ts": "exit_ts"}, "exit_ts")


def by_lifetime(rows: DataFrame, creates: DataFrame) -> DataFrame:
    """Owners of events and parents of processes, in one pass: (row_id, role, made, confidence), ``made`` the creation's row.

    By the identity that the tool gives, else by process number: the latest creation of the number that had not ended. A
    creation is never its own parent: if it is found so, it has none.
    """
    is_create = F.expr("car_object = 'process' AND car_action = 'create'")
    role = F.when(is_create, F.lit("parent")).otherwise(F.lit("owner"))
    told = F.when(is_create, native("ParentProcessGuid")).otherwise(F.col("owning_guid_native"))
    number = hex_int(F.when(is_create, F.col("parent_pid")).otherwise(F.col("owning_pid")))
    asking = rows.select("row_id", *SCOPE, "ts", role.alias("role"), told.alias("told"), number.alias("pid")).where("told IS NOT NULL OR pid IS NOT NULL")
    index = creates.where("guid IS NOT NULL").select(*SCOPE, "guid", F.col("row_id").alias("made"), order().alias("at"))
    sure = joins.lookup(asking, index, {"source": "source", "source_host": "source_host", "told": "guid"}, {"made": "made"}, "at", last=True)
    numbered = creates.where("pid IS NOT NULL").withColumn("seq", F.col("row_id"))
    likely = joins.owner_as_of(sure.where("made IS NULL AND pid IS NOT NULL").select("row_id", "role", *SCOPE, "ts", "pid"), numbered, [*SCOPE, "pid"], guid="row_id")
    found = sure.where("made IS NOT NULL").select("row_id", "role", "made", F.lit(DEFINITIVE).alias("confidence"))
    found = found.unionByName(likely.where("owning_guid IS NOT NULL").select("row_id", "role", F.col("owning_guid").alias("made"), F.lit(HEURISTIC).alias("confidence")))
    return found.where("made <> row_id")


def process_facts(rows: DataFrame, creates: DataFrame) -> DataFrame:
    """Owner, or parent, of each row, how sure it is, and what the row takes over from it."""
    found = by_lifetime(rows, creates).alias("f")
    made = creates.select(F.col("row_id").alias("made"), "guid", "props")
    both = found.join(made, "made")
    owned, born = F.col("role") == "owner", F.col("role") == "parent"
    columns = {"owner_guid": F.when(owned, F.col("guid")), "parent_guid": F.when(born, F.col("guid")), "link_confidence": F.col("confidence")}
    taken = {f: F.when(owned, prop(f)) for f in OWNER_INHERITS} | {b: F.when(born, prop(a)) for a, b in PARENT_INHERITS.items()}
    return facts(both, 3, columns, taken)


def thread_facts(rows: DataFrame, creates: DataFrame) -> DataFrame:
    """The process that a thread was put into, by the tool's identity."""
    asking = rows.where("car_object = 'thread'").select("row_id", *SCOPE, native("TargetProcessGuid").alias("target")).where("target IS NOT NULL")
    index = creates.where("guid IS NOT NULL").select(*SCOPE, "guid", F.col("guid").alias("found"), order().alias("at"))
    met = joins.lookup(asking, index, {"source": "source", "source_host": "source_host", "target": "guid"}, {"found": "found"}, "at", last=True).where("found IS NOT NULL")
    return facts(met, 4, evidence={"target_process_guid": F.col("found"), "target_process_link": F.lit(DEFINITIVE)})


def flow_facts(rows: DataFrame) -> DataFrame:
    """The connection that a request or a transferred file rides, by the capture's identity, and what it tells of it."""
    flows = rows.where("car_object = 'flow'").select(*SCOPE, F.coalesce("guid", native("uid")).alias("uid"), F.col("guid").alias("flow"), "props", F.struct(F.col("source_artefact") != "zeek_conn", order()).alias("at")).where("uid IS NOT NULL")
    asking = rows.where("car_object IN ('http', 'file')").select("row_id", *SCOPE, native("uid").alias("uid")).where("uid IS NOT NULL")
    # in the order of flows the connection's own record comes before what else the sensor saw in it
    met = joins.lookup(asking, flows, {"source": "source", "source_host": "source_host", "uid": "uid"}, {"flow": "flow", "props": "props"}, "at").where("props IS NOT NULL")
    return facts(met, 1, {"flow_guid": F.col("flow")}, {b: prop(a) for a, b in FLOW_INHERITS.items()}, {"flow_guid": F.col("flow"), "flow_link": F.lit(DEFINITIVE)})


def name_facts(rows: DataFrame) -> DataFrame:
    """Names of the ends of connections: resolved by the host's own queries, else as the client asked for in its handshake."""
    flows = rows.where("car_object = 'flow'")
    answers = F.explode(F.from_json(native("answers"), "array<string>"))
    resolved = flows.where("source_artefact = 'zeek_dns'").select(*SCOPE, prop("fqdn").alias("name"), order().alias("at"), answers.alias("ip")).where("name IS NOT NULL").where(ids.is_ip(F.col("ip")))
    uid = F.coalesce("guid", native("uid"))
    asked = flows.where("source_artefact = 'zeek_ssl'").select(*SCOPE, uid.alias("uid"), prop("dest_fqdn").alias("name"), order().alias("at")).where("name IS NOT NULL AND uid IS NOT NULL")
    out = flows.select("row_id", *SCOPE, prop("dest_ip").alias("dest"), prop("src_ip").alias("src"), uid.alias("uid"))
    for end in ("dest", "src"):
        out = joins.lookup(out, resolved, {"source": "source", "source_host": "source_host", end: "ip"}, {"name": f"{end}_name"}, "at")
    out = joins.lookup(out, asked, {"source": "source", "source_host": "source_host", "uid": "uid"}, {"name": "sni"}, "at")
    return facts(out.where("COALESCE(dest_name, src_name, sni) IS NOT NULL"), 2, props={"dest_fqdn": F.coalesce("dest_name", "sni"), "src_fqdn": F.col("src_name")})


def certificate_facts(rows: DataFrame) -> DataFrame:
    """The subject of the first certificate of a chain that a source has seen, of connections that presented it."""
    seen = rows.where("source_artefact = 'zeek_x509'").select("source", F.coalesce("guid", prop("sha256_hash")).alias("print"), native("certificate.subject").alias("subject"), order().alias("at")).where("print IS NOT NULL AND nullif(subject, '') IS NOT NULL")
    index = joins.one_of_each(seen, ["source", "print"], "at").select("source", "print", "subject")
    chains = rows.where("car_object = 'flow'").where(prop("application_protocol") == "tls").select("row_id", "source", F.posexplode(F.from_json(native("cert_chain_fps"), "array<string>")).alias("place", "print"))
    met = chains.join(index, ["source", "print"]).groupBy("row_id").agg(F.min_by("subject", "place").alias("subject"))
    return facts(met, 5, evidence={"server_cert_subject": F.col("subject")})


def executed_facts(rows: DataFrame, creates: DataFrame) -> DataFrame:
    """The first process that was started from a file's path on its host, and how many were if several."""
    image = F.lower(F.coalesce(present(prop("image_path")), present(prop("exe"))))
    started = creates.select(*SCOPE, image.alias("path"), "guid", order().alias("at")).where("path IS NOT NULL")
    files = rows.where("car_object = 'file'").select("row_id", *SCOPE, F.lower(present(prop("file_path"))).alias("path")).where("path IS NOT NULL")
    met = joins.first_and_count(files, started, {k: k for k in (*SCOPE, "path")}, "guid", "at").where("candidates IS NOT NULL")
    return facts(met, 6, evidence={"executed_as_process_guid": F.col("first_guid"), "executed_as_process_link": F.lit(HEURISTIC), "executed_as_process_count": F.when(F.col("candidates") > 1, F.col("candidates"))})


def session_facts(rows: DataFrame) -> DataFrame:
    """Ends of sessions at their beginnings and the other way round.

    A logout closes the first login of its session, told by the logon identity, else by the session's number. A login is
    ended by the last of the logouts that close it. Both are told in native bags: the model has no end of a session.
    """
    own = rows.where("car_object = 'user_session'")
    keyed = own.select("row_id", *SCOPE, "car_action", "guid", "timestamp", F.lower(present(prop("login_id"))).alias("luid"), present(native("SessionID")).alias("number"), order().alias("at"))
    opened = keyed.where(F.col("car_action").isin(OPENING)).withColumn("login", F.struct("row_id", "guid"))
    closed = keyed.where(F.col("car_action").isin(CLOSING))
    for key in ("luid", "number"):
        closed = joins.lookup(closed, opened.where(F.col(key).isNotNull()), {"source": "source", "source_host": "source_host", key: key}, {"login": f"by_{key}"}, "at")
    pairs = closed.withColumn("login", F.coalesce("by_luid", "by_number")).where("login IS NOT NULL")
    ended = pairs.groupBy(F.col("login.row_id").alias("row_id")).agg(F.max_by(F.struct("guid", "timestamp"), "at").alias("last"))
    return facts(pairs, 7, evidence={"session_login_guid": F.col("login.guid")}).unionByName(facts(ended, 7, evidence={"session_logout_guid": F.col("last.guid"), "session_end": F.col("last.timestamp")}))


def authentication_facts(rows: DataFrame) -> DataFrame:
    """The session that a success opened and the one that it was requested from, by logon identities; a failure opens none."""
    sessions = rows.where("car_object = 'user_session'").select(*SCOPE, F.lower(present(prop("login_id"))).alias("luid"), "guid", order().alias("at"), F.lit(True).alias("found")).where("luid IS NOT NULL")
    usable = lambda key: F.lower(present(native(key)))
    asking = rows.where("car_object = 'authentication'").select("row_id", *SCOPE, F.when(F.col("car_action") == "success", usable("TargetLogonId")).alias("target"), usable("SubjectLogonId").alias("subject"))
    evidence = {}
    for end in ("target", "subject"):
        asking = asking.withColumn(end, F.when(~F.col(end).isin(NULL_LUIDS), F.col(end)))
        asking = joins.lookup(asking, sessions, {"source": "source", "source_host": "source_host", end: "luid"}, {"guid": f"{end}_guid", "found": f"{end}_found"}, "at", last=True)
        sure = F.when(F.col(end).isin(WELL_KNOWN_LUIDS), HEURISTIC).otherwise(DEFINITIVE)
        evidence |= {f"{end}_session_guid": F.col(f"{end}_guid"), f"{end}_session_link": F.when(F.col(f"{end}_found"), sure)}
    return facts(asking.where("target_found OR subject_found"), 8, evidence=evidence)


COLUMNS = ["owner_guid", "parent_guid", "flow_guid", "link_confidence"]


def with_facts(rows: DataFrame, every: list[DataFrame]) -> DataFrame:
    """``rows`` with what all stages found, of a field what the first stage says, and only where the row and its object have place for it."""
    together = reduce(DataFrame.unionByName, every).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("stage", F.to_json("columns").alias("columns"), F.to_json("fill").alias("fill"), F.to_json("evidence").alias("evidence")))).alias("all"))
    merged = lambda name: F.aggregate(F.transform("all", lambda x: F.from_json(x[name], BAG)), F.create_map().cast(BAG), lambda have, more: F.map_concat(F.map_filter(more, lambda k, v: ~F.map_contains_key(have, k)), have))
    found = together.select(F.col("row_id").alias("_id"), merged("columns").alias("_columns"), merged("fill").alias("_fill"), merged("evidence").alias("_evidence"))
    out = rows.join(found, rows["row_id"] == found["_id"], "left").drop("_id")
    fields = F.create_map(*(x for kind, f in FIELDS.items() for x in (F.lit(kind), F.array(*(F.lit(n) for n in f)))))
    own = F.try_element_at(fields, "car_object")
    missing = F.map_filter("_fill", lambda k, v: F.array_contains(own, k) & present(F.try_element_at("props", k)).isNull())
    filled = F.when(F.col("_fill").isNotNull(), put(F.col("props"), missing)).otherwise(F.col("props"))
    owner, target = F.try_element_at("_columns", F.lit("owner_guid")), F.try_element_at("_evidence", F.lit("target_process_guid"))
    # a thread within its own process is no injection
    evidence = F.when(owner == target, F.map_filter("_evidence", lambda k, v: ~k.startswith("target_process"))).otherwise(F.col("_evidence"))
    bag = F.when(F.col("_evidence").isNotNull(), put(F.col("native"), evidence)).otherwise(F.col("native"))
    columns = {c: F.try_element_at("_columns", F.lit(c)) for c in COLUMNS}
    return out.withColumns({"props": filled, "native": bag} | columns).drop("_columns", "_fill", "_evidence")


def stages(rows: DataFrame) -> list[DataFrame]:
    creates = processes(rows)
    return [
        flow_facts(rows), name_facts(rows), process_facts(rows, creates), thread_facts(rows, creates), certificate_facts(rows), executed_facts(rows, creates),
        session_facts(rows), authentication_facts(rows),
    ]
