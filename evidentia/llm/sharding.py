"""Minimax contiguous sharding: the smallest feasible capacity over ordered atomic groups, then cuts there.

Rows with equal texts form one atom. Atoms are ordered by a 64-bit hash of the text, cut into ``n_shards`` contiguous
runs, and the largest run is as small as any contiguous cut allows. Groups heavier than an equal share come first and
have a shard each; the minimax cut is made over the rest.

The driver never sees atoms. It holds sums of hash ranges (4096 to begin with) and asks Spark for finer sums only of
the ranges in which a cut can still fall, at most ``ZOOM_ROWS`` rows a round, until the bounds on the capacity meet.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import cut, text_or_empty

TOP_SHIFT = 52
ZOOM_ROWS = 1 << 16
SLOT_BUCKETS_PER_SHARD = 256


@dataclass(frozen=True)
class Span:
    """All atoms whose key shifted right by ``shift`` is ``prefix``."""

    prefix: int
    shift: int
    total: int
    largest: int
    atoms: int

    @property
    def low(self) -> int:
        return self.prefix << self.shift

    @property
    def open(self) -> bool:
        return self.atoms > 1


def pack_whole(spans: list[Span], capacity: int) -> list[int]:
    """Greedy cut with whole spans: index of the first span of every shard."""
    starts, load = [0], 0
    for i, s in enumerate(spans):
        if load and load + s.total > capacity:
            starts.append(i)
            load = 0
        load += s.total
    return starts


def pack_divisible(spans: list[Span], capacity: int) -> list[int]:
    """Greedy cut that may fall anywhere within a span of several atoms: positions (in size units) of the shard ends.

    No real cut can reach further, so the number of shards is a lower bound.
    """
    ends, position, load = [], 0, 0
    for s in spans:
        left = s.total
        if not s.open:
            if load + left > capacity:
                ends.append(position)
                load = 0
            load += left
            position += left
            continue
        while load + left > capacity:
            step = capacity - load
            position += step
            left -= step
            ends.append(position)
            load = 0
        load += left
        position += left
    return [*ends, position]


def smallest(feasible, low: int, high: int) -> int:
    while low < high:
        middle = (low + high) // 2
        if feasible(middle):
            high = middle
        else:
            low = middle + 1
    return low


def minimax(spans: list[Span], shards: int) -> tuple[int, int]:
    """Bounds on the smallest feasible capacity, which meet when no open span matters any more."""
    total = sum(s.total for s in spans)
    floor = max([1, -(-total // shards), *(s.largest for s in spans)])
    low = smallest(lambda c: len(pack_divisible(spans, c)) <= shards, floor, max(floor, total))
    whole = max([low, *(s.total for s in spans)])
    high = smallest(lambda c: len(pack_whole(spans, c)) <= shards, whole, max(whole, total))
    return low, high


def undecided(spans: list[Span], low: int, high: int, shards: int) -> list[Span]:
    """Open spans in which a greedy cut may fall for a capacity from low to high."""
    before = [0]
    for s in spans:
        before.append(before[-1] + s.total)
    furthest = pack_divisible(spans, high)[:-1]
    nearest, start = [], 0
    for _ in furthest:
        start = before[min(len(spans), bisect_right(before, start + low) - 1)]
        nearest.append(start)
    found: set[int] = set()
    for near, far in zip(nearest, furthest, strict=True):
        first = max(0, bisect_right(before, near) - 1)
        last = min(len(spans) - 1, bisect_right(before, far) - 1)
        found.update(i for i in range(first, last + 1) if spans[i].open and spans[i].shift)
    return [spans[i] for i in sorted(found)]


def range_sums(atoms: DataFrame, shift: int, within: list[Span] | None = None) -> list[Span]:
    """Sums of the atoms by key prefix; ``within`` limits them to some wider prefixes."""
    if within is not None:
        atoms = atoms.where(F.shiftright("key", within[0].shift).isin([s.prefix for s in within]))
    rows = atoms.groupBy(F.shiftright("key", shift).alias("prefix")).agg(F.sum("size").alias("total"), F.max("size").alias("largest"), F.count("*").alias("atoms")).collect()
    return [Span(r.prefix, shift, r.total, r.largest, r.atoms) for r in sorted(rows, key=lambda r: r.prefix)]


def contiguous_cuts(atoms: DataFrame, shards: int) -> list[int]:
    """Keys at which shards 1, 2, ... begin; fewer than ``shards - 1`` where there are few atoms."""
    spans = range_sums(atoms, TOP_SHIFT)
    while spans:
        low, high = minimax(spans, shards)
        zoom = undecided(spans, low, high, shards) if low < high else []
        if not zoom:
            return [spans[i].low for i in pack_whole(spans, high)[1:]]
        # finest first would skew the widths; one width at a time keeps the request a plain prefix list
        widest = max(s.shift for s in zoom)
        zoom = [s for s in zoom if s.shift == widest]
        bits = max(1, min(12, widest, int(log2(ZOOM_ROWS / len(zoom)))))
        fine = range_sums(atoms, widest - bits, zoom)
        gone = {(s.prefix, s.shift) for s in zoom}
        spans = sorted([s for s in spans if (s.prefix, s.shift) not in gone] + fine, key=lambda s: s.low)
    return []


def heavy_atoms(atoms: DataFrame, shards: int) -> tuple[list[int], int]:
    """Keys of the atoms above an equal share of what is left, heaviest first (under ``shards`` of them)."""
    top = atoms.orderBy(F.desc("size"), "key").limit(shards).collect()
    total = atoms.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    keys = []
    for r in top:
        left = shards - len(keys)
        if left < 2 or r["size"] * left <= total:
            break
        keys.append(r.key)
        total -= r["size"]
    return keys, shards - len(keys)


def shard_of(key: Column, heavy: list[int], cuts: list[int]) -> Column:
    shard = F.lit(len(heavy))
    for c in cuts:
        shard = shard + (key >= F.lit(c)).cast("int")
    for i, k in reversed(list(enumerate(heavy))):
        shard = F.when(key == F.lit(k), F.lit(i)).otherwise(shard)
    return shard.cast("int")


def shard_documents(docs: DataFrame, n_shards: int = 16, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Row id, size (UTF-8 bytes + 1), text_crc32, law (`bytes`), shard, slot and grown_shard (null under this law).

    A null text counts as an empty one. Rows with equal texts share a shard. Slots run from 0 without gaps in every
    shard; they are numbered in hashed buckets of row ids and offset by the buckets before, so that neither a shard nor
    a group of copies meets in one task. An empty table gives no rows; repeated rows each have a slot of their own;
    other columns are ignored.
    """
    body = text_or_empty(text)
    rows = cut(
        docs.select(
            F.col(row_id).alias("doc_id"),
            (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("key"),
        )
    )
    atoms = cut(rows.groupBy("key").agg(F.sum("size").alias("size")))
    heavy, left = heavy_atoms(atoms, n_shards)
    light = atoms.where(~F.col("key").isin(heavy)) if heavy else atoms
    cuts = contiguous_cuts(light, left)
    placed = rows.withColumn("shard", shard_of(F.col("key"), heavy, cuts)).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_BUCKETS_PER_SHARD)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # n_shards * SLOT_BUCKETS_PER_SHARD rows at most, whatever the input
    offsets = placed.groupBy("shard", "bucket").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    numbered = placed.withColumn("within", F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "key")))
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
