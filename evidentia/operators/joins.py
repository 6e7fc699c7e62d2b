"""Links between events of one source. Keys compare null-safely: a null host is a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.blanks import present
from evidentia.plans.tables import written

#: Microseconds from the start of the year one to that of 1970.
EPOCH_MICROS = 62_135_596_800_000_000

def same(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> Column:
    """Null-safe equality of several keys (name on the left: name on the right)."""
    on = F.lit(True)
    for a, b in keys.items():
        on = on & left[a].eqNullSafe(right[b])
    return on


def one_of_each(rows: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """The first (or last) row of each key, by an aggregation that is combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return rows.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_one")).select(*keys, *(F.col("_one")[c].alias(c) for c in rest))


def lookup(rows: DataFrame, found: DataFrame, keys: dict[str, str], take: dict[str, str], order: str, last: bool = False, how: str = "left") -> DataFrame:
    """``rows`` with columns of the first (last) match: ``take`` maps columns of ``found`` to new names."""
    index = one_of_each(found.select(*dict.fromkeys([*keys.values(), *take, order])), list(keys.values()), order, last)
    index = index.select(*(F.col(b).alias(f"_k_{k}") for k, b in enumerate(keys.values())), *(F.col(a).alias(b) for a, b in take.items()))
    return rows.join(index, same(rows, index, {a: f"_k_{k}" for k, a in enumerate(keys)}), how).drop(*(f"_k_{k}" for k in range(len(keys))))


def inherit(rows: DataFrame, owner: str, fields: dict[str, str]) -> DataFrame:
    """Missing fields filled from a joined struct: owner's field to own field."""
    return rows.withColumns({own: F.coalesce(present(F.col(own)), F.col(f"{owner}.{theirs}")) for theirs, own in fields.items()})


#: A key is hot with more than one row in so many, and is then cut into this many stretches of time.
HOT_SHARE, STRETCHES = 1000, 64


def last_seen(stream: DataFrame, keys: list[str], at: str, order: list[str], values: dict[str, Column], peaks: dict[str, Column]) -> DataFrame:
    """``stream`` with, of each value, the last one that is not null up to the row, in the order of ``order`` within its keys, and of each peak the largest one.

    ``at`` is the first column of the order, a long. The rows of hot keys, of which there are fewer than HOT_SHARE, are dealt by
    stretches of it, at quantiles of the key; what was last before a stretch is carried into it. ``stream`` is read several times.
    """
    sizes = written(stream.groupBy(*keys).agg(F.count("*").alias("_rows")))
    total = sizes.agg(F.sum("_rows").alias("n")).first().n or 0
    hot = written(sizes.where(F.col("_rows") * HOT_SHARE > total).where(F.col("_rows") > STRETCHES * STRETCHES).drop("_rows"))
    if hot.isEmpty():
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return stream.withColumns({n: F.last(v, ignorenulls=True).over(upto) for n, v in values.items()} | {n: F.max(v).over(upto) for n, v in peaks.items()})
    steps = F.array(*(F.lit(k / STRETCHES) for k in range(1, STRETCHES)))
    of_hot = stream.join(F.broadcast(hot), same(stream, hot, {k: k for k in keys}), "left_semi")
    cuts = of_hot.groupBy(*keys).agg(F.percentile_approx(at, steps, F.lit(1000)).alias("_cuts"))
    cuts = cuts.select(*(F.col(k).alias(f"_c_{k}") for k in keys), "_cuts")
    dealt = stream.join(F.broadcast(cuts), same(stream, cuts, {k: f"_c_{k}" for k in keys}), "left").drop(*(f"_c_{k}" for k in keys))
    dealt = dealt.withColumn("_stretch", F.when(F.col("_cuts").isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda c: c <= F.col(at))))).withColumns({f"_v_{n}": v for n, v in (values | peaks).items()})
    within = Window.partitionBy(*keys, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = dealt.withColumns({n: F.last(f"_v_{n}", ignorenulls=True).over(within) for n in values} | {n: F.max(f"_v_{n}").over(within) for n in peaks})
    # the last value, and the peak, of every stretch of the hot keys, and from these what each stretch begins with
    place = F.struct(*order)
    ends = dealt.where("_stretch >= 0").groupBy(*keys, "_stretch").agg(*(F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)).alias(n) for n in values), *(F.max(f"_v_{n}").alias(n) for n in peaks))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*(F.col(k).alias(f"_c_{k}") for k in keys), F.col("_stretch").alias("_c_stretch"), *(F.last(n, ignorenulls=True).over(earlier).alias(f"_b_{n}") for n in values), *(F.max(n).over(earlier).alias(f"_b_{n}") for n in peaks))
    out = own.join(F.broadcast(carried), same(own, carried, {k: f"_c_{k}" for k in keys} | {"_stretch": "_c_stretch"}), "left")
    return out.select(*stream.columns, *(F.coalesce(n, f"_b_{n}").alias(n) for n in values), *(F.greatest(n, f"_b_{n}").alias(n) for n in peaks))


#: Bits of a time in microseconds since the year one.
LEVELS = 60


def innermost(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, take: Column, order: Column) -> DataFrame:
    """``points`` whose time lies in a span of their keys, with ``taken`` of the span that comes last by ``order``.

    A span is a few aligned stretches, each of a power of two, and a time lies in one stretch of each size, so that this is an
    equi-join: rows are made only of spans that hold the point. ``at``, ``start`` and ``end`` are longs, of 0 at least.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1)))
    cut = spans.select(*keys, F.col(start), F.col(end), take.alias("_take"), order.alias("_order"), level.alias("_level"))
    shifted = lambda c: F.call_function("shiftright", c, F.col("_level"))
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    first, last = shifted(F.col(start) + width - 1), shifted(F.col(end) + 1) - 1
    ends = F.array_compact(F.array(F.when((first <= last) & (first % 2 == 1), first), F.when((first <= last) & (last % 2 == 0), last)))
    parts = cut.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "_take", "_order", F.col("_level").alias("_k_level"), F.explode(ends).alias("_k_part"))
    asked = points.withColumn("_level", level).withColumn("_part", shifted(F.col(at)))
    # both sides are exploded, which the estimate of their sizes does not count: never a broadcast
    met = asked.join(parts.hint("merge"), same(asked, parts, {k: f"_k_{k}" for k in keys} | {"_level": "_k_level", "_part": "_k_part"}))
    return met.groupBy(*points.columns).agg(F.max_by("_take", "_order").alias("taken"), F.max("_order").alias("taken_order"))


def owner_as_of(spokes: DataFrame, creates: DataFrame, keys: list[str], guid: str = "guid", at: str = "ts", ended: str = "exit_ts", row: str = "row_id", seq: str = "seq") -> DataFrame:
    """``spokes`` with ``owning_guid``: the latest create of the same keys at or before the spoke that had not ended.

    The latest create before each spoke, the latest without an end, and the latest end so far come from one pass over the union
    of both, sorted by time. If the latest had ended already, the spoke goes to what is later of the latest one without an end and
    of the creates with an end in whose lifetimes it lies; there is none of these if the latest end so far lies before the spoke.
    Nothing is compared per pair, and hot keys are cut by time. A create without a time counts as the earliest; a spoke without a
    time is linked only to a lone create of its keys.
    """
    clock = lambda c: F.unix_micros(c) + EPOCH_MICROS
    made = creates.select(*keys, F.coalesce(clock(F.col(at)), F.lit(0).cast("long")).alias("_at"), clock(F.col(ended)).alias("_end"), F.col(guid).alias("_guid"), F.col(seq).alias("_seq"))
    create = F.struct("_at", "_seq", "_guid", "_end")
    timed = spokes.where(F.col(at).isNotNull()).select(*keys, clock(F.col(at)).alias("_at"), row)
    nothing = lambda of, c: F.lit(None).cast(of.schema[c].dataType)
    born = made.withColumn("_made", create)
    stream = born.select(*keys, "_at", F.lit(0).alias("_kind"), "_seq", "_made", nothing(spokes, row).alias(row)).unionByName(
        timed.select(*keys, "_at", F.lit(1).alias("_kind"), nothing(made, "_seq").alias("_seq"), nothing(born, "_made").alias("_made"), row)
    )
    seen = last_seen(
        stream, keys, "_at", ["_at", "_kind", "_seq"], {"_last": F.col("_made"), "_open": F.when(F.col("_made._end").isNull(), F.col("_made"))}, {"_reach": F.col("_made._end")}
    ).where("_kind = 1")
    alive = F.col("_last._end").isNull() | (F.col("_last._end") >= F.col("_at"))
    found = F.when(alive, F.col("_last._guid")).otherwise(F.col("_open._guid")).alias("owning_guid")
    # the latest has ended, and an earlier one may not have
    covered = ~alive & (F.col("_reach") >= F.col("_at"))
    latest = written(seen.where("_last IS NOT NULL").select(row, *keys, "_at", covered.alias("_covered"), found, F.struct("_open._at", "_open._seq").alias("_open_order")))
    linked, asking = latest.where("NOT _covered").select(row, "owning_guid"), latest.where("_covered").drop("_covered")
    if not asking.isEmpty():
        some = asking.select(*keys).distinct()
        closed = made.where("_end IS NOT NULL AND _end >= _at").join(some, same(made, some, {k: k for k in keys}), "left_semi")
        within = innermost(asking.select(row, *keys, "_at"), closed, keys, "_at", "_at", "_end", F.col("_guid"), F.struct("_at", "_seq")).select(F.col(row).alias("_in"), "taken", "taken_order")
        both = asking.join(within, asking[row] == within["_in"], "left")
        later = F.col("taken_order").isNotNull() & (F.col("_open_order._at").isNull() | (F.col("taken_order") > F.col("_open_order")))
        linked = linked.unionByName(both.select(row, F.when(later, F.col("taken")).otherwise(F.col("owning_guid")).alias("owning_guid")))
    lone = made.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_guid").alias("owning_guid")).where("_n = 1").drop("_n")
    untimed = spokes.where(F.col(at).isNull()).select(row, *keys)
    single = untimed.join(lone, same(untimed, lone, {k: k for k in keys})).select(untimed[row], lone["owning_guid"])
    return spokes.join(linked.unionByName(single), row, "left")


def pair_sessions(logins: DataFrame, logouts: DataFrame, keys: list[str], order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Logins with ``session_end`` (of the last logout of their keys) and logouts with ``login_guid`` (the first login)."""
    ended = lookup(logins, logouts, {k: k for k in keys}, {"timestamp": "session_end"}, order, last=True)
    opened = lookup(logouts, logins, {k: k for k in keys}, {"guid": "login_guid"}, order)
    return ended, opened


def first_match_in_list(rows: DataFrame, row: str, values: str, index: DataFrame, key: str, take: str, order: str) -> DataFrame:
    """``rows`` with ``take`` of the first list element that the index has."""
    one = one_of_each(index.select(key, take, order), [key], order).select(F.col(key).alias("_value"), take)
    hits = rows.select(row, F.posexplode(values).alias("_pos", "_value")).join(one, "_value").groupBy(row).agg(F.min_by(take, "_pos").alias(take))
    return rows.join(hits, row, "left")


def first_and_count(rows: DataFrame, found: DataFrame, keys: dict[str, str], guid: str, order: str) -> DataFrame:
    """``rows`` with ``first_guid`` and ``candidates`` of their keys."""
    index = found.groupBy(*(F.col(b).alias(f"_k_{k}") for k, b in enumerate(keys.values()))).agg(F.min_by(guid, order).alias("first_guid"), F.count("*").alias("candidates"))
    return rows.join(index, same(rows, index, {a: f"_k_{k}" for k, a in enumerate(keys)}), "left").drop(*(f"_k_{k}" for k in range(len(keys))))


def link_one_to_one(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, prefer: Column | None = None) -> DataFrame:
    """(left_id, right_id) where a left row has one candidate, or one that ``prefer`` leaves; no edge otherwise.

    Candidates are counted by key before the join; only keys with several are joined to see what is preferred.
    """
    counted = right.where(F.concat_ws("", *keys) != "").groupBy(*keys).agg(F.count("*").alias("_n"), F.min(right_id).alias(right_id))
    whole = left.join(counted, keys)
    single = whole.where("_n = 1").select(left_id, right_id)
    if prefer is None:
        return single
    many = left.join(counted.where("_n > 1").select(*keys), keys, "left_semi")
    narrowed = many.join(right, keys).where(prefer).groupBy(left_id).agg(F.count("*").alias("_n"), F.min(right_id).alias(right_id)).where("_n = 1")
    return single.unionByName(narrowed.select(left_id, right_id))


def priority_match(candidates: list[DataFrame], row: str) -> DataFrame:
    """Of several candidate joins, in falling priority, the matches of the best one that a row has."""
    every = candidates[0].withColumn("prio", F.lit(0))
    for k, c in enumerate(candidates[1:], 1):
        every = every.unionByName(c.withColumn("prio", F.lit(k)))
    best = every.groupBy(row).agg(F.min("prio").alias("prio"))
    return every.join(best, [row, "prio"])


def any_field_match(evidence: DataFrame, row: str, fields: dict[str, list[str]], indicators: DataFrame, kind: str = "kind", value: str = "value") -> DataFrame:
    """(row, indicator columns, field) of any of many field pairs, as one equi-join over unpivoted fields."""
    flat = F.array(*(F.struct(F.lit(k).alias(kind), F.lit(f).alias("field"), F.col(f).cast("string").alias(value)) for k, fs in fields.items() for f in fs))
    long = evidence.select(row, F.explode(flat).alias("e")).select(row, "e.*").where(F.col(value).isNotNull())
    return long.join(indicators, [kind, value])
