"""Spelling variants: a trie self-join with active-node sets over a vocabulary that is partitioned by prefixes.

Words of a vocabulary are near if one inserted, deleted or replaced code point parts them. A trie node's active nodes are
those within distance one of it; they follow from its parent's, and a word is near those of its active nodes that end words.

The trie is cut into partitions. Up to the place where two near words first differ they share a prefix, and after it a
suffix. With the shorter word's length as class, that place lies either in the first half of the class, and the words share
what follows it, or not, and they share the prefix before it: so each class has a partition for every prefix of half its
length, and one, of the trie of middles, for every suffix. A partition above LIMIT words is cut again in the same way: by a
longer prefix and by a longer suffix. A window of one code point is never that large, so partitions are bounded, whatever
prefix or suffix words share, and each pair belongs to the one partition in whose window it first differs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import cut, drop, text_or_empty

RUN = r"[A-Za-zÀ-ÿ]+"
#: Capital letters that are lowered, and the divisor of the hash by which runs lose a code point.
UPPER, LOWER, DELETE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", 199
MIN_LENGTH, MIN_COUNT, FORM_FACTOR = 6, 5, 5
#: Most words of a partition that one task holds at a time; above what a window of one code point can have.
LIMIT = 20_000
NEAR = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("near", T.StringType()), T.StructField("near_n", T.LongType())])


def lowered(run: Column) -> Column:
    """A-Z lowered and no other letter; runs of one-byte characters go the faster way of ``lower``."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def vocabulary(docs: DataFrame, text: str = "text", row_id: str = "doc_id", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n: the runs of all texts, some with one code point deleted by their hash, that are long and frequent enough.

    The hash of a row without an id is taken over an empty id. Only words and their counts are shuffled.
    """
    runs = docs.select(F.coalesce(F.col(row_id).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text_or_empty(text), F.lit(RUN), 0)).alias("run"))
    low = runs.select("id", lowered(F.col("run")).alias("run"))
    hashed = low.withColumn("hash", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    place = F.pmod("hash", F.length("run")).cast("int")
    cropped = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("hash") % DELETE == 0, cropped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def partitioned(words: DataFrame) -> DataFrame:
    """Each word in its class and in that of words one shorter, under a prefix and a suffix of half the class.

    ``size`` is the class, ``head`` and ``tail`` how many code points partners share before and after the window.
    """
    classes = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")).where("size >= 0")
    half = F.floor(F.col("size") / 2).cast("int")
    cuts = F.array(F.struct(half.alias("head"), F.lit(0).alias("tail")), F.struct(F.lit(0).alias("head"), (F.col("size") - half).alias("tail")))
    return keyed(classes.select("word", "n", "size", F.explode(F.array_distinct(cuts)).alias("c")).select("word", "n", "size", "c.head", "c.tail"))


def keyed(rows: DataFrame) -> DataFrame:
    shared = F.concat(F.substring("word", F.lit(1), F.col("head")), F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail")))
    return rows.select("word", "n", "size", "head", "tail", shared.alias("shared"))


def split_once(rows: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """``rows`` with partitions of more than ``limit`` words cut by a longer prefix and a longer suffix; whether any was."""
    key = ["size", "head", "tail", "shared"]
    window = F.col("size") - F.col("head") - F.col("tail")
    large = cut(rows.groupBy(*key).agg(F.count("*").alias("words")).where((F.col("words") > limit) & (window > 1)).select(*key, F.lit(True).alias("large")))
    if large.isEmpty():
        drop(large)
        return rows, False
    half = F.floor(window / 2).cast("int")
    same = F.struct("head", "tail")
    finer = F.array(F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")), F.struct(F.col("head").alias("head"), (F.col("tail") + window - half).alias("tail")))
    # partitions are many and hold few words each, but for the large ones: these are few, so their keys are sent to the rows
    known = rows.join(F.broadcast(large) if large.count() <= limit else large, key, "left")
    cuts = F.when(F.col("large"), finer).otherwise(F.array(same))
    return keyed(known.select("word", "n", "size", F.explode(cuts).alias("c")).select("word", "n", "size", "c.head", "c.tail")), True


class Trie:
    """Nodes as lists: children by code point, and the word that ends there."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends = [-1]
        for k, (middle, _) in enumerate(words):
            at = 0
            for c in middle:
                down = self.children[at].get(c)
                if down is None:
                    down = self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                at = down
            self.ends[at] = k

    def near(self) -> Iterator[tuple[int, int]]:
        """Pairs of different words at distance one, in both directions.

        The active nodes of a node at distance zero are the node itself, and at distance one its parent, its siblings and
        its children, besides the children, by the same code point, of what was active at distance one of its parent.
        """
        children, ends = self.children, self.ends
        stack: list[tuple[int, set[int]]] = [(0, set(children[0].values()))]
        while stack:
            node, active = stack.pop()
            if ends[node] >= 0:
                for other in active:
                    if ends[other] >= 0:
                        yield ends[node], ends[other]
            own = children[node]
            for c, down in own.items():
                following = {children[a][c] for a in active if c in children[a]}
                following.update(children[down].values())
                following.update(own.values())
                following.add(node)
                following.discard(down)
                stack.append((down, following))


def near_in_partition(members: list[tuple[str, int]], size: int, head: int, tail: int) -> Iterator[tuple[str, int, str, int]]:
    """Near pairs of a partition that first differ in its window, of words of which one at least has the class's length."""
    last = head + (size - head - tail) + (tail == 0)
    trie = Trie([(w[head : len(w) - tail], n) for w, n in members])
    for a, b in trie.near():
        (x, n), (y, m) = members[a], members[b]
        if min(len(x), len(y)) != size:
            continue
        short = min(len(x), len(y))
        first = head
        while first < short and x[first] == y[first]:
            first += 1
        if first < last:
            yield x, n, y, m


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, n, near, near_n: all pairs of the vocabulary at distance one, in both directions, each once."""
    rows, more = partitioned(words), True
    while more:  # a window halves each time
        rows, more = split_once(rows, limit)

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str, int]] = []
        key, members = None, []

        def flush() -> None:
            if len(members) > 1:
                out.extend(near_in_partition(members, *key[:3]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("size", "head", "tail", "shared", "word", "n")]
            for size, head, tail, shared, word, n in zip(*columns, strict=True):
                if key != (size, head, tail, shared):
                    flush()
                    key, members = (size, head, tail, shared), []
                members.append((word, n))
            if len(out) > 10_000:
                yield to_batch(out)
                out = []
        flush()
        yield to_batch(out)

    def to_batch(rows: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], names=NEAR.names)

    key = ["size", "head", "tail", "shared"]
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(join, NEAR)


def forms(near: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """word, n_near, form, form_n: of its near words the one of largest n, ties to the smallest, if it is frequent enough."""
    first = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"), F.col("near_n"))).alias("first"))
    enough = F.col("first.near_n") >= factor * F.col("n")
    return first.select("word", "n_near", F.when(enough, F.col("first.near")).alias("form"), F.when(enough, F.col("first.near_n")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """word and root of the words that have a form, by pointer doubling: n grows along forms, so chains end, after few steps."""
    links = cut(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = cut(links.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("on")))
        done = moved.where("on").isEmpty()
        drop(links)
        links = moved.drop("on")
        if done:
            return links


def spelling_variants(docs: DataFrame, text: str = "text", row_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    A null text has no words; a row without an id hashes as one of an empty id; a repeated row counts again. Words of any
    length take part. Other columns are ignored. An empty table gives no rows.
    """
    words = cut(vocabulary(docs, text, row_id))
    formed = cut(forms(near_words(words, limit)))
    found = words.join(formed, "word", "left").join(roots(formed), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
