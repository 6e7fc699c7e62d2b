"""Repeated byte strings by bucket-pointer refinement, over a sparse suffix array.

Every window of ``length`` bytes is represented by the leftmost smallest ``q``-gram within it, so that equal windows
choose the same one; neighbouring windows with the same choice form a segment. Segments begin in the bucket of their
q-gram. A bucket is then refined:

* one segment alone: none of its windows occurs elsewhere;
* segments with equal contents: all their windows do;
* the rest, at the edges of repeats: one segment of each content is refined alone, by the bucket identifiers of longer
  grams. An identifier of a longer gram is made of two identifiers of the shorter one, of a position and of a later
  offset, as the level before has them. The last level has the identifiers of whole windows, and 128 bits.

Spark does the bucket sort of each level as an aggregation and a join on the bucket identifier; only identifiers and
positions are shuffled, and from the second level on only the edges of repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import cut

LENGTH = 400
#: Gram length of the first and the second level, of ``LENGTH``.
LEVELS = (0.5, 0.94)
POSITION_BITS = 24
#: Bytes of strings that are processed as one, and the most of one string.
LOT, CHUNK = 1 << 17, 1 << 22
U = np.uint64


class Grams:
    """Identifiers of the q-grams of one byte string, for growing q."""

    #: Fixed seeds: two odd multipliers, and a random value for each byte.
    BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
    TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), dtype=np.uint64)

    def __init__(self, codes: np.ndarray, which: int):
        powers, self.inverse = powers_of(self.BASES[which], len(codes).bit_length())
        self.sums = np.zeros(len(codes) + 1, U)
        np.cumsum(self.TABLE[which][codes] * powers[: len(codes)], out=self.sums[1:])

    def first(self, q: int) -> np.ndarray:
        return scramble((self.sums[q:] - self.sums[:-q]) * self.inverse[: len(self.sums) - q])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U))


@lru_cache(maxsize=8)
def powers_of(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**bits powers of a base and of its inverse, modulo 2**64."""
    ones = np.ones(1, U)
    return tuple(np.multiply.accumulate(np.concatenate((ones, np.full((1 << bits) - 1, U(b), U)))) for b in (base, pow(base, -1, 1 << 64)))


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def refined(ids: np.ndarray, q: int, longer: int) -> np.ndarray:
    """Identifiers of ``longer``-grams from those of q-grams (longer <= 2 q): of a position, and of the offset at which
    the second q-gram ends the longer one."""
    offset = longer - q
    return scramble(ids[: len(ids) - offset] * U(0x9E3779B97F4A7C15) + ids[offset:]) if offset else ids


def grams_of_windows(ids: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` grams the position of its leftmost smallest one."""
    packed = (ids >> U(POSITION_BITS) << U(POSITION_BITS)) | np.arange(len(ids), dtype=U)
    n, span, low = len(packed) - width + 1, 1, packed
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[width - span : width - span + n])
    return (low & U((1 << POSITION_BITS) - 1)).astype(np.int64)


def level_ids(grams: Grams, level: int, length: int) -> tuple[np.ndarray, int]:
    """Identifiers and gram length of a level; the last level has whole windows."""
    q = int(length * LEVELS[0])
    ids = grams.first(q)
    for share in [*LEVELS[1 : level + 1], 1] if level == len(LEVELS) else LEVELS[1 : level + 1]:
        longer = int(length * share)
        ids, q = refined(ids, q, longer), longer
    return ids, q


class Lot:
    """Byte strings processed as one: their windows are found in the joined bytes, without those across two strings."""

    def __init__(self, strings: list[tuple[bytes, int, int, int, int]], length: int):
        self.codes = np.frombuffer(b"".join(s[0] for s in strings), np.uint8)
        sizes = np.array([len(s[0]) for s in strings])
        starts = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        self.windows = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
        self.owner = np.repeat(np.arange(len(strings)), counts)
        # base names the row that the bytes are of, also for a later part of it; skip is where that part begins in the row
        self.k1, self.k2, self.base, skip = (np.array([s[i] for s in strings], np.int64) for i in (1, 2, 3, 4))
        self.shift = self.base + skip - starts


def lots(batches: Iterator[pa.RecordBatch], length: int, chunk: int) -> Iterator[Lot]:
    """Strings of ``length`` bytes or more in lots of some ``LOT`` bytes; those over ``chunk`` in overlapping parts."""
    strings, size = [], 0
    for batch in batches:
        for data, k1, k2, base in zip(batch.column("data"), batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("base").to_pylist(), strict=True):
            whole = data.as_py() or b""
            for skip in range(0, len(whole) - length + 1, chunk):
                own = whole[skip : skip + chunk + length - 1] if len(whole) > chunk else whole
                if len(own) < length:
                    break
                strings.append((own, k1, k2, base, skip))
                size += len(own)
                if size >= LOT:
                    yield Lot(strings, length)
                    strings, size = [], 0
    if strings:
        yield Lot(strings, length)


def find_segments(df: DataFrame, level: int, length: int, chunk: int = CHUNK) -> DataFrame:
    """Segments of the windows in ``data``; ``base`` is where ``data`` begins in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in lots(batches, length, chunk):
            ids, q = level_ids(Grams(lot.codes, 0), level, length)
            at = grams_of_windows(ids, length - q + 1)[lot.windows]
            first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (lot.owner[1:] != lot.owner[:-1]))))
            lo, hi = lot.windows[first], lot.windows[np.append(first[1:], len(at)) - 1]
            gram, owner = at[first], lot.owner[first]
            content = Grams(lot.codes, 1).of(lo, hi + length) + scramble((gram - lo).astype(U))
            columns = [ids[gram].view(np.int64), content.view(np.int64), lot.k1[owner], lot.k2[owner]]
            columns += [x.astype(np.int32) for x in (lot.base[owner], lo + lot.shift[owner], hi + lot.shift[owner])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "content", "k1", "k2", "base", "lo", "hi"])

    return df.select("data", "k1", "k2", "base").mapInArrow(run, "bucket long, content long, k1 long, k2 long, base int, lo int, hi int")


def find_windows(df: DataFrame, length: int, chunk: int = CHUNK) -> DataFrame:
    """Both identifiers of every window in ``data``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in lots(batches, length, chunk):
            ids = [level_ids(Grams(lot.codes, which), len(LEVELS), length)[0][lot.windows].view(np.int64) for which in (0, 1)]
            columns = [*ids, lot.k1[lot.owner], lot.k2[lot.owner], (lot.windows + lot.shift[lot.owner]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "content", "k1", "k2", "lo"])

    return df.select("data", "k1", "k2", "base").mapInArrow(run, "bucket long, content long, k1 long, k2 long, lo int")


def settle(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments whose windows all occur elsewhere, segments to refine) of one level."""
    buckets = found.groupBy("bucket").agg(F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")).where("n > 1")
    # written apart from the join, so that Spark can split a bucket that many segments share
    shared = cut(found.join(cut(buckets.select("bucket", (F.col("least") == F.col("most")).alias("same"))), "bucket"))
    mixed = shared.where("NOT same")
    row = F.struct("k1", "k2", "base", "lo", "hi")
    contents = cut(mixed.groupBy("bucket", "content").agg(F.count("*").alias("n"), F.min(row).alias("one")))
    again = mixed.join(contents.where("n > 1").select("bucket", "content"), ["bucket", "content"], "left_semi")
    whole = shared.where("same").select("k1", "k2", "lo", "hi").unionByName(again.select("k1", "k2", "lo", "hi"))
    return whole, contents.select("one.*")


def take(segs: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The bytes of segments, cut from ``texts`` (k1, k2, base, data), in their order of position."""
    lists = segs.groupBy("k1", "k2", "base").agg(F.collect_set(F.struct("lo", "hi")).alias("segs"))
    joined = texts.join(lists, ["k1", "k2", "base"]).select("k1", "k2", F.col("base").alias("from"), "data", F.explode("segs").alias("s"))
    return joined.select("k1", "k2", F.col("s.lo").alias("base"), F.substring("data", F.col("s.lo") - F.col("from") + 1, F.col("s.hi") - F.col("s.lo") + length).alias("data"))


def repeated_spans(rows: DataFrame, length: int, chunk: int = CHUNK) -> DataFrame:
    """(k1, k2, spans): start and end of strings in which each byte is covered by a repeated window.

    ``rows`` has k1, k2 and binary ``data``; the keys name a text, and equal ones have equal data.
    """
    texts = rows.where(F.octet_length("data") >= length).withColumn("base", F.lit(0))
    found = []
    for level in range(len(LEVELS)):
        whole, edges = settle(find_segments(texts, level, length, chunk))
        found.append(whole.select("k1", "k2", "lo", (F.col("hi") + length).alias("end")))
        texts = cut(take(edges, texts, length))
    windows = find_windows(texts, length, chunk)
    counted = cut(windows.groupBy("bucket", "content").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "content"))
    found.append(windows.join(counted, ["bucket", "content"], "left_semi").select("k1", "k2", "lo", (F.col("lo") + length).alias("end")))
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every.groupBy("k1", "k2").agg(F.collect_set(F.struct(F.col("lo").alias("start"), "end")).alias("spans"))


REMOVED = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))), T.StructField("kept", T.BinaryType())])


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", row_id: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the maximal removed byte runs of every text, and the bytes that stay.

    A byte goes where a string of ``length`` bytes around it also starts anywhere else in the table, in the same text
    or another; no string crosses texts. A null text is an empty one; texts shorter than ``length`` stay whole;
    repeated rows repeat each other and lose all such bytes; an empty table gives none; other columns are ignored.
    ``kept`` is binary: a cut may fall within a character. ``chunk`` bytes of a text are read at once.
    """
    keyed = docs.select(
        F.col(row_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
        F.xxhash64(text).alias("k1"), F.xxhash64(row_id, F.length(text)).alias("k2"),
    )
    spans = cut(repeated_spans(keyed.drop("doc_id"), length, chunk))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for data, found in zip(batch.column("data").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                own = united([(x["start"], x["end"]) for x in found or ()])
                edges = [0, *(x for r in own for x in r), len(data)]
                runs.append([{"start": s, "end": e} for s, e in own])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in batch.column("data").to_pylist()], pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    schema = T.StructType([keyed.schema["doc_id"], T.StructField("n_bytes", T.LongType()), *REMOVED.fields])
    return keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "data", "spans").mapInArrow(run, schema)
