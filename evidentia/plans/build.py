"""The build path: raw tool output to linked events, edges and a timeline, all sources of a case in one job.

Every row carries ``source``; every key has it first, so that sources stay apart although they share the job.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import markers, times
from evidentia.functions.blanks import present
from evidentia.operators import fold, graph
from evidentia.plans import derived, links, maps
from evidentia.plans.model import ASSOCIATIONS, FIELDS
from evidentia.plans.tables import shared_folder, written
from evidentia.sources import jsonl


def parse(spark: SparkSession, files: list[tuple[str, str, str | None]]) -> DataFrame:
    """Events of (source, path, default host) files, each by the maps of its name; files of equal maps are one scan.

    A .jsonl file without a route is taken for a container of many parsers' records and split into a table for each.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    parts = []
    for source, path, host in files:
        if names := maps.route(path):
            groups.setdefault((*names, source, host or ""), []).append(path)
        elif path.endswith(".jsonl") and not maps.known(path):
            folder = shared_folder(spark, "container")
            for table in jsonl.container_tables(spark, path, path.rsplit("/", 1)[-1], folder):
                if names := maps.route(f".{table}"):
                    parts.append((jsonl.read_container_table(spark, folder, table), names, source, host))
    parts += [(jsonl.scan(spark, paths).drop("path"), list(names), source, host or None) for (*names, source, host), paths in groups.items()]
    out = None
    for records, names, source, host in parts:
        events = maps.mapped(records.withColumn("source", F.lit(source)), names, host)
        out = events if out is None else out.unionByName(events)
    if out is None:
        raise ValueError("no file has a map")
    return out.withColumn("ts", times.parse_ts(F.col("timestamp"))).withColumn("row_id", row_identity())


def row_identity() -> Column:
    """Identity of an event row by its contents; equal rows are one event to the fold."""
    return F.sha1(F.concat_ws("|", "source", "source_host", "car_object", "car_action", "guid", "timestamp", "source_artefact", F.to_json("props"), F.to_json("native")))


def folded(events: DataFrame) -> DataFrame:
    """One row for each event of a source, see ``fold.merged``."""
    # several accesses of a process are told by what they were to and how
    apart = {f"_{k}": links.prop(k) for k in ("target_guid", "access_level")}
    keys = ["source", "source_host", "car_object", "guid", "car_action", *apart]
    # a table: events are read several times, and their maps are large plans
    return fold.merged(written(events.withColumns(apart)), keys, ["timestamp", "source_artefact", "row_id"]).drop(*apart)


def linked(events: DataFrame) -> DataFrame:
    """Events with all that links tell, account names first, so that what is inherited is canonical."""
    rows = written(links.canonical(links.lifted(events)))
    return links.with_facts(rows, links.stages(rows))


METHODS = {links.DEFINITIVE: "native_guid", links.HEURISTIC: "pid_window"}


def association(key: str) -> Column:
    """Facts of a relation itself, as a JSON text; of each the first place that has it."""
    places = ASSOCIATIONS.get(key, {})
    place = lambda p: links.native(p.removeprefix("native.")) if p.startswith("native.") else links.prop(p)
    told = links.known({name: F.coalesce(*(present(place(p)) for p in of)) for name, of in places.items()})
    return F.when(F.size(told) > 0, F.to_json(told)) if places else F.lit(None).cast("string")


def edges(rows: DataFrame, objects: Collection[str] = tuple(FIELDS)) -> DataFrame:
    """All relations that linked events declare, a scan for all kinds. ``objects`` are the event objects that the rows can have.

    Owners and what they did, parents, accesses and injections, changes of processes, what a connection contained, processes
    and the files that they ran, and the sessions of authentications.
    """
    own = lambda kind, action=None: (F.col("car_object") == kind) & (F.lit(True) if action is None else F.col("car_action") == action)
    guid, owner, native = F.col("guid"), F.col("owner_guid"), links.native
    link = {"confidence": F.col("link_confidence"), "method": markers.map_value(F.col("link_confidence"), METHODS)}
    said = lambda confidence, method: {"confidence": confidence, "method": F.lit(method)}
    scope = {"source": F.col("source"), "source_host": F.col("source_host"), "class": F.lit("declared")}

    def edge(verb: Column, start: tuple[str, Column], end: tuple[str, Column], when: Column, told: dict[str, Column], key: str = "") -> Column:
        properties = association(key) if isinstance(key, str) else key
        return graph.edge(verb, start, end, when & (start[1] != end[1]), F.col("ts"), **scope, **told, properties=properties)

    kinds = []
    for kind in FIELDS:
        if kind != "process" and kind in objects:
            actions = [k.split("/")[1] for k in ASSOCIATIONS if k.startswith(f"{kind}/")]
            properties = F.coalesce(*(F.when(F.col("car_action") == a, association(f"{kind}/{a}")) for a in actions), F.lit(None).cast("string"))
            kinds.append(edge(graph.verb_of(F.lit(kind), F.col("car_action")), ("process", owner), (kind, guid), own(kind), link, properties))
            if kind != "flow":
                kinds.append(edge(F.lit("contained"), ("flow", native("flow_guid")), (kind, guid), own(kind), said(native("flow_link"), "capture_uid")))
            kinds.append(edge(F.lit("executed"), ("process", native("executed_as_process_guid")), (kind, guid), own(kind), said(native("executed_as_process_link"), "image_path")))
    of_processes = [
        edge(F.lit("created"), ("process", F.col("parent_guid")), ("process", guid), own("process", "create"), link),
        edge(F.lit("accessed"), ("process", owner), ("process", links.prop("target_guid")), own("process", "access"), link, "edge:process_access"),
        edge(F.lit("modified"), ("process", native("modifier_process_guid")), ("process", guid), own("process", "modify"), said(native("modifier_process_link"), "native_guid")),
    ]
    of_sessions = [edge(F.lit("created"), ("authentication", guid), ("user_session", native(f"{end}_session_guid")), own("authentication"), said(native(f"{end}_session_link"), "luid")) for end in ("target", "subject")]
    kinds.append(edge(F.lit("accessed"), ("process", owner), ("process", native("target_process_guid")), F.lit(True), said(native("target_process_link"), "native_guid"), "edge:thread_injection"))
    kinds += (of_processes if "process" in objects else []) + (of_sessions if "authentication" in objects else [])
    return graph.edges(rows, kinds)


def timeline(rows: DataFrame, relations: DataFrame, host: str | None = None, after: str | None = None, before: str | None = None) -> DataFrame:
    objects = rows.select("ts", F.col("car_object").alias("object"), F.col("source_host").alias("host"), "guid", F.col("car_action").alias("detail"))
    links = relations.select(F.col("timestamp").alias("ts"), F.col("target_object").alias("object"), F.col("source_host").alias("host"), F.col("target_guid").alias("guid"), F.col("relationship").alias("detail"))
    return graph.timeline([("object", objects), ("relationship", links)], host, after, before)


def build(spark: SparkSession, files: list[tuple[str, str, str | None]], out: str) -> None:
    """Linked events by source and object, relations by source, inferred and content nodes, as Parquet tables under ``out``."""
    linked(folded(parse(spark, files))).write.mode("overwrite").partitionBy("source", "car_object").parquet(f"{out}/events")
    rows = spark.read.parquet(f"{out}/events")
    derived.relations(rows).unionByName(edges(rows), allowMissingColumns=True).write.mode("overwrite").partitionBy("source").parquet(f"{out}/edges")
    derived.inferred_nodes(rows).write.mode("overwrite").partitionBy("source").parquet(f"{out}/inferred")
    derived.content_nodes(rows).write.mode("overwrite").parquet(f"{out}/content")
