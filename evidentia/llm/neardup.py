"""Near duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates.

Documents of equal shingle sets are one class. A class has one hash value a bin, the smallest of its shingles there;
an empty bin takes the value of another one, found by a fixed random walk. Bands of bins are buckets. A bucket gives one
star, not all pairs: its centre is the class that shares most buckets with others (what copies were made from), and
every candidate is confirmed on the full sets.

Points of a star that are in several components after the stars are contested: a link between two of them may be missing. A
centre has been compared with all of its bucket, so a bucket of two classes leaves nothing open. The contested classes are dealt into smaller groups by their rare shingles. Where the similarity of two sets is high enough,
both have a common shingle so early in the order of rarity that what follows can still hold the needed intersection, and
their sizes are near; so a class is found under its early shingles and sizes only. Nothing is compared within a component,
and no link between contested classes is lost: the groups follow from the threshold, not from chance.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import cut, drop

SHINGLE, PERCENT = 5, 80
#: At a similarity of 0.8 a pair shares no bucket with a probability of 3 in a million.
BANDS, ROWS = 24, 4
WALK = 96
#: Size classes of contested sets to a power of two: more of them give fewer candidates and more rows to find them.
SIZE_PARTS = 32
#: The filter of classes in shared buckets has a fixed size; if it fills up, more sets than needed are shuffled.
FILTER_BITS = 1 << 26
SLICE = 64
#: Rows of a batch that are worked on at once; what is held is bounded by their texts.
ROWS_AT_ONCE = 512
U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0xD6E8FEB86659FD93
TABLE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def word_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of lower-cased bytes."""
    space = np.concatenate(([True], SPACE[codes], [True]))
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    powers = np.multiply.accumulate(np.concatenate((np.ones(1, U), np.full(len(codes), U(BASE), U))))
    inverse = np.multiply.accumulate(np.concatenate((np.ones(1, U), np.full(len(codes), U(pow(BASE, -1, 1 << 64)), U))))
    sums = np.concatenate((np.zeros(1, U), np.cumsum(TABLE[codes] * powers[:-1], dtype=U)))
    return starts, scramble((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words than ``size``, the whole sequence is one."""
    blobs = [t.encode() for t in texts]
    out: list[np.ndarray] = []
    for at in range(0, len(blobs), SLICE):
        part = blobs[at : at + SLICE]
        codes = LOWER[np.frombuffer(b" ".join(part) or b" ", np.uint8)]
        starts, words = word_hashes(codes)
        edges = np.searchsorted(starts, np.cumsum([0, *(len(b) + 1 for b in part)]))
        grams = words
        for k in range(1, size):
            grams = scramble(grams[: len(words) - k] * U(0x9E3779B97F4A7C15) + words[k:]) if len(words) > k else grams[:0]
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a >= size:
                own = np.sort(grams[a : b - size + 1])
                out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
            elif b > a:
                whole = words[a : a + 1]
                for k in range(a + 1, b):
                    whole = scramble(whole * U(0x9E3779B97F4A7C15) + words[k : k + 1])
                out.append(scramble(whole + U(b - a)))
            else:
                out.append(words[:0])
    return out


def walks(bins: int) -> np.ndarray:
    """For each bin the bins in which it looks for a value, in this order; at last all of them."""
    rng = np.random.default_rng(20240302)
    return np.hstack([rng.integers(0, bins, (bins, WALK)), np.tile(np.arange(bins), (bins, 1))])


def signature(own: np.ndarray, bins: int, walk: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin, bins being equal ranges of the hash; empty ones densified."""
    at = np.searchsorted(own, edges)
    full = at < np.append(at[1:], len(own))
    values = own[np.minimum(at, len(own) - 1)]
    if full.all():
        return values
    empty = np.flatnonzero(~full)
    first = full[walk[empty]].argmax(axis=1)
    values = values.copy()
    values[empty] = values[walk[empty, first]]
    return values


def parts(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, arrays)], dtype=np.int32), np.concatenate([np.empty(0, np.int64), *arrays]))


def describe(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n, c, bands): set size, class (digest of the set; null if empty) and bucket of every band."""
    bins = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = walks(bins)
        edges = np.array([(k << 64) // bins for k in range(bins)], U)
        mark = scramble(np.arange(1, bands + 1, dtype=U))
        for batch in parts(batches):
            sets = shingle_sets([t or "" for t in batch.column("text").to_pylist()], size)
            classes = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            buckets = []
            for s in sets:
                if len(s):
                    v = signature(s, bins, walk, edges).reshape(bands, rows)
                    h = mark
                    for k in range(rows):
                        h = scramble(h * U(0x9E3779B97F4A7C15) + v[:, k])
                    buckets.append(h.view(np.int64))
                else:
                    buckets.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.binary()), lists(buckets)],
                ["doc_id", "n", "c", "bands"],
            )

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("c", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(run, schema)


def filter_bits(reps: DataFrame) -> np.ndarray:
    """Bits of the (class, representative) pairs, ``FILTER_BITS`` at most."""
    bit = F.crc32(F.concat("c", F.coalesce(F.col("rep").cast("string"), F.lit("")).cast("binary"))).bitwiseAND(FILTER_BITS - 1) + 1
    parts = reps.select(bit.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts:
        out[(r.part - 1) * 4096 : r.part * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def full_sets(docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """(c, s): the sorted shingle hashes of every class in ``reps`` (c, rep), from its representative's text."""
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(reps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ids = batch.column("doc_id").to_pylist()
            sets = shingle_sets([t or "" for t in batch.column("text").to_pylist()], size)
            found: dict[bytes, np.ndarray] = {}
            for i, s in zip(ids, sets, strict=True):
                if len(s):
                    c = blake2b(s.tobytes(), digest_size=16).digest()
                    bit = zlib.crc32(c + (b"" if i is None else str(i).encode())) & (FILTER_BITS - 1)
                    if bits.value[bit >> 3] >> (bit & 7) & 1:
                        found[c] = s.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), lists(list(found.values()))], ["c", "s"])

    sets = docs.mapInArrow(run, "c binary, s array<long>")
    return sets.join(reps.select("c"), "c", "left_semi").groupBy("c").agg(F.first("s").alias("s"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("c").alias("b"), F.col("s").alias("s_b")), "b").join(sets.select(F.col("c").alias("a"), F.col("s").alias("s_a")), "a")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.where(common * (100 + percent) >= (F.size("s_a") + F.size("s_b")) * percent).select("a", "b")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(c, comp): the smallest class within reach, by passing labels along edges and following them in turn."""
    links = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = nodes.select("c", F.col("c").alias("comp"))
    while True:
        near = links.join(labels.withColumnRenamed("c", "b"), "b").groupBy(F.col("a").alias("c")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "c", "left").select("c", F.least("comp", F.coalesce("near", "comp")).alias("next"), "comp")
        ahead = lower.select(F.col("c").alias("next"), F.col("next").alias("after"))
        last, labels = labels, cut(lower.join(ahead, "next", "left").select("c", F.coalesce("after", "next").alias("comp"), (F.coalesce("after", "next") != F.col("comp")).alias("moved")))
        drop(last)
        if not labels.where("moved").limit(1).count():
            drop(links)
            return labels


def stars(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(band, c, n, w) of the classes that share a bucket with another one, the largest w, then c, being the centre; and their stars, pairs (a, b) of near sizes."""
    rows = classes.select("c", "n", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    sized = rows.join(shared, "band")
    members = cut(sized.join(sized.groupBy("c").agg(F.sum("size").alias("w")), "c").select("band", "c", "n", "w"))
    centres = members.groupBy("band").agg(F.max(F.struct("w", "c", "n")).alias("m"))
    near = F.least("n", "m.n") * 100 >= F.greatest("n", "m.n") * percent
    met = members.join(centres, "band").where((F.col("c") != F.col("m.c")) & near)
    return members, met.select(F.least("c", "m.c").alias("a"), F.greatest("c", "m.c").alias("b")).distinct()


def part_of(size: Column) -> Column:
    """Number of the size class of a set; a power of two has ``SIZE_PARTS`` of them. In whole numbers, so it is the same everywhere."""
    power = F.length(F.bin(size)) - 1
    return (power * SIZE_PARTS + F.floor(size * SIZE_PARTS / F.pow(F.lit(2.0), power))).cast("int")


def early_shingles(live: DataFrame, percent: int) -> DataFrame:
    """Where a class of ``live`` is to be found: (shingle, part, id, n, least, most, larger).

    ``live`` (id, n, shingle, count) has the shingles that several components have, with the number of their classes. All
    others come first in the order of a set, then these, by count. With i shingles of a set before it, a shingle may be the
    first common one of sets of n and m, of different components, only if (100 + percent) * (n - i) >= percent * (n + m). The
    larger set looks for the sizes least to most, in each part of the sizes; the smaller one lies in the part of its own, and
    most is the largest that may find it.
    """
    left = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("count"), F.desc("shingle")))
    most = F.floor(left * (100 + percent) / percent).cast("long") - F.col("n")
    least = F.ceil(F.col("n") * percent / 100).cast("long")
    early = live.withColumn("most", most).withColumn("least", least).where("most >= least").select("shingle", "id", "n", "least", "most")
    small = early.where("most >= n").withColumn("part", part_of(F.col("n"))).withColumn("larger", F.lit(False))
    large = early.withColumn("most", F.least("most", "n")).withColumn("part", F.explode(F.sequence(part_of(F.col("least")), part_of(F.least("most", "n"))))).withColumn("larger", F.lit(True))
    return small.unionByName(large)


def contested_pairs(contested: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of ``contested`` (c, n, comp), of different components, that may be similar enough: none is missing. And the table they are read from."""
    of = contested.select("c", "n", F.xxhash64("c").alias("id"), F.xxhash64("comp").alias("k"))
    shingles = sets.join(of, "c").select("id", "k", "n", F.explode("s").alias("shingle"))
    several = shingles.groupBy("shingle").agg(F.count("*").alias("count"), F.min("k").alias("low"), F.max("k").alias("high")).where("low <> high").select("shingle", "count")
    found = cut(early_shingles(shingles.drop("k").join(several, "shingle"), percent).join(of.select("id", "k", "c"), "id"))
    group = ["shingle", "part"]
    small, large = found.where("not larger"), found.where("larger")
    # components first, so that the members of one are not compared with each other
    smaller = small.groupBy(*group, F.col("k").alias("k_s")).agg(F.min("n").alias("m_low"), F.max("n").alias("m_high"), F.max("most").alias("up_to"))
    larger = large.groupBy(*group, F.col("k").alias("k_l")).agg(F.min("least").alias("low"), F.max("most").alias("high"), F.min("n").alias("n_low"))
    met = smaller.join(larger, group).where("k_s <> k_l and m_low <= high and m_high >= low and up_to >= n_low").select(*group, "k_s", "k_l")
    pairs = (
        met.join(small.select(*group, F.col("k").alias("k_s"), F.col("c").alias("c_s"), F.col("n").alias("m"), F.col("most").alias("up_to")), [*group, "k_s"])
        .join(large.select(*group, F.col("k").alias("k_l"), F.col("c").alias("c_l"), "n", "least", "most"), [*group, "k_l"])
        .where("m between least and most and n <= up_to")
        .select(F.least("c_s", "c_l").alias("a"), F.greatest("c_s", "c_l").alias("b")).distinct()
    )
    return pairs, found


def open_points(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(c) of the classes that have been compared with their bucket's centre only, where the bucket's others are in several components."""
    comps = members.join(labels.select("c", "comp"), "c").groupBy("band", "comp").agg(F.count("*").alias("size"), F.max(F.struct("w", "c", "n")).alias("m"))
    buckets = comps.groupBy("band").agg(F.count("*").alias("comps"), F.max(F.struct("m", "size")).alias("of"))
    # without the centre, its component may have no one left
    split = buckets.where((F.col("comps") > 2) | (F.col("comps") == 2) & (F.col("of.size") > 1)).select("band", F.col("of.m.c").alias("centre"))
    return members.join(split, "band").where("c <> centre").select("c").distinct()


def link(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(c, comp) of the classes that share a bucket with another class; None if no class does."""
    members, pairs = stars(classes, percent)
    shared = cut(members.select("c", "n").distinct())
    if not shared.limit(1).count():
        drop(members, shared)
        return None
    sets = cut(full_sets(docs, classes.join(shared, "c", "left_semi").select("c", "rep"), size))
    links = cut(confirmed(pairs, sets, percent))
    labels = components(shared, links)
    contested = cut(open_points(members, labels).join(labels.select("c", "comp"), "c").join(shared, "c"))
    drop(members, links)
    more, found = contested_pairs(contested, sets, percent)
    joined = confirmed(more, sets, percent)
    first, second = (labels.select(F.col("c").alias(k), F.col("comp").alias(f"comp_{k}")) for k in ("a", "b"))
    between = cut(joined.join(first, "a").join(second, "b").where("comp_a <> comp_b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct())
    roots = components(between.select(F.col("a").alias("c")).union(between.select("b")).distinct(), between)
    lower = roots.select(F.col("c").alias("comp"), F.col("comp").alias("lower"))
    out = cut(labels.join(lower, "comp", "left").select("c", F.coalesce("lower", "comp").alias("comp")))
    drop(contested, found, between, roots, labels, sets, shared)
    return out


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; kept rows are the smallest of their components.

    Words are runs of anything but blanks, with A-Z lower-cased. Texts with 100 * intersection >= percent * union of
    their ``size``-word shingle sets are linked, confirmed on the full sets. A text of fewer words is one shingle; one
    without words, or null, is linked with nothing. Repeated rows are in one component, and each of them is kept if
    theirs is the smallest id. A component of null ids has a null component_id and is kept. An empty table gives none.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).alias("text"))
    meta = cut(describe(rows, size, BANDS, ROWS))
    # copies fall together before anything is dealt by buckets
    classes = cut(meta.where("n > 0").groupBy("c").agg(F.first("n").alias("n"), F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    labels = link(rows, classes, size, percent)
    ids = classes.select("c", F.col("rep").alias("component_id"))
    if labels is not None:
        placed = ids.join(labels, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
        ids = placed.join(placed.groupBy("comp").agg(F.min("component_id").alias("least")), "comp").select("c", F.col("least").alias("component_id"))
    found = meta.drop("bands").join(ids, "c", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = cut(found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept")))
    drop(meta, classes, labels)
    return out
