"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two words counts the three-symbol subsequences that they share, each weighed by ``DECAY`` to the length
it spans, so that gapped and inserted characters cost little; it is scaled by what a word of that length could reach.
A text is judged by its worst words, so the machine is trained on words of the labelled sentences: those that mark
toxic texts against common, random and (found in further passes) the most similar harmless ones. A logistic turns the
means of the worst ``TOPS`` distinct words into a probability. Landmarks span the feature space. Since the kernel is an inner product over subsequences, the trained
combination of landmarks collapses into one table of subsequence weights; scoring is exact and needs no landmark.

The model is fitted on a bounded sample: ``TOXIC_DOCS`` and ``CLEAN_DOCS`` labelled rows at most, in the order of a hash.
All texts are scored, whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import nlargest
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import cut

TOXIC_DOCS, CLEAN_DOCS = 3000, 6000
MARKERS, COMMON, RANDOM, HARD = 400, 800, 800, 1500
LANDMARKS = 800
DECAY = 0.6
#: Lengths of the subsequences, and the most that one may leave out between its symbols.
ORDERS, GAP = (3, 4, 5), 3
#: Subsequences are hashed into a table of so many weights.
BUCKETS = 1 << 21
LONGEST, STRIDE = 24, 12
TOPS = (1, 2, 4, 8)
#: Decision values are cut to this range; the lower end also stands for words that a short text has not.
LEAST, MOST = -2.0, 1.5
PASSES = 2
PENALTY = 20.0
CACHE_WORDS = 400_000
SLICE = 256

NOT_WORD = re.compile(r"[\W_]+")
SPELLED = re.compile(r"(?<!\w)\w(?:[\W_]{1,2}\w(?!\w)){2,}")


def pieces(token: str) -> list[str]:
    """The words of one token: its letters and digits together, in overlapping parts where it is long."""
    word = NOT_WORD.sub("", token)
    if len(word) <= LONGEST:
        return [word] if len(word) > 2 else []
    return [word[i : i + LONGEST] for i in range(0, len(word) - STRIDE, STRIDE)]


def tokens(text: str) -> set[str]:
    """The distinct tokens of a text, and words spelled out letter by letter."""
    low = text.lower()
    out = set(low.split())
    out.update(m[0] for m in SPELLED.finditer(low))
    return out


def symbols(words: list[str]) -> np.ndarray:
    """Codes of words of one length, with a start mark."""
    points = np.array([[0, *map(ord, w)] for w in words], np.int64)
    return np.where(points < 38, points % 38, np.where((points >= 97) & (points < 123), points - 59, 64 + points % 64)) 


@lru_cache(maxsize=LONGEST + 2)
def gaps(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the positions of the subsequences of a word of n symbols, and their scaled weights."""
    out = []
    for order in ORDERS:
        index = [(i, *(i + r for r in rest)) for i in range(n) for rest in combinations(range(1, min(order + GAP, n - i)), order - 1)]
        if index:
            index = np.array(index, np.int64)
            weights = DECAY ** (index[:, -1] - index[:, 0] + 1.0)
            out.append((index, weights / np.sqrt((weights**2).sum() * len(ORDERS))))
    return out


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the subsequences of words of one length, and their scaled weights."""
    s = symbols(words)
    parts = gaps(s.shape[1])
    codes = []
    for index, _ in parts:
        code = np.full((len(words), len(index)), index.shape[1], np.int64)
        for k in range(index.shape[1]):
            code = (code * 1000003 + s[:, index[:, k]] + 1) & 0xFFFFFFFFFFF
        codes.append((code ^ (code >> 21)) % BUCKETS)
    return np.hstack(codes), np.concatenate([w for _, w in parts])


def products(words: list[str], table: np.ndarray) -> np.ndarray:
    """Inner products of words with a table of subsequence weights."""
    out = np.zeros(len(words))
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        for k in range(0, len(at), 512):
            codes, weights = subsequences([words[i] for i in at[k : k + 512]])
            out[at[k : k + 512]] = table[codes] @ weights
    return out


class Kernel:
    """Kernel values among the words of a training set, from their subsequences in one flat array."""

    def __init__(self, words: list[str]):
        parts = [subsequences([w]) for w in words]
        self.codes, self.index = np.unique(np.concatenate([c[0] for c, _ in parts]), return_inverse=True)
        self.weights = np.concatenate([w for _, w in parts])
        self.starts = np.cumsum([0, *(len(w) for _, w in parts)])

    def column(self, k: int) -> np.ndarray:
        table = np.zeros(len(self.codes))
        own = slice(self.starts[k], self.starts[k + 1])
        np.add.at(table, self.index[own], self.weights[own])
        return np.add.reduceat(table[self.index] * self.weights, self.starts[:-1])

    def collapsed(self, landmarks: list[int], factors: np.ndarray) -> np.ndarray:
        """The table of the landmarks' combination."""
        table = np.zeros(BUCKETS)
        for k, a in zip(landmarks, factors, strict=True):
            own = slice(self.starts[k], self.starts[k + 1])
            np.add.at(table, self.codes[self.index[own]], a * self.weights[own])
        return table


class Model:
    """Subsequence weights and bias of the machine, and the logistic over a text's worst words."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table.astype(np.float32), bias
        self.logistic = np.zeros(len(TOPS) + 1)
        self.seen: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def words(self, words: list[str]) -> np.ndarray:
        return products(words, self.table) + self.bias

    def features(self, texts: list[str]) -> np.ndarray:
        """Means of the ``TOPS`` highest decision values among the distinct tokens of each text."""
        split = [tokens(t) for t in texts]
        if len(self.seen) > CACHE_WORDS:
            self.seen = {}
        new = list(set().union(*split).difference(self.seen)) if split else []
        parts = [pieces(t) for t in new]
        distinct = list({w for p in parts for w in p})
        values = dict(zip(distinct, np.clip(self.words(distinct), LEAST, MOST).tolist() if distinct else [], strict=True))
        seen, count = self.seen, max(TOPS)
        for token, p in zip(new, parts, strict=True):
            seen[token] = max((values[w] for w in p), default=LEAST)
        out = np.full((len(texts), count), LEAST)
        for k, s in enumerate(split):
            top = nlargest(count, map(seen.__getitem__, s))
            out[k, : len(top)] = top
        means = np.cumsum(out, axis=1) / np.arange(1, count + 1)
        return means[:, [t - 1 for t in TOPS]]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.logistic[:-1] + self.logistic[-1], -500, 500)))


def fit_machine(positive: dict[str, float], negative: dict[str, float]) -> Model:
    """Squared-hinge machine on Nystroem features of words with weights, both classes of equal weight.

    The landmarks are the heaviest words of either class.
    """
    words = [*positive, *negative]
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    weight = np.array([*positive.values(), *negative.values()])
    cost = PENALTY * np.where(y > 0, weight / weight[y > 0].sum(), weight / weight[y < 0].sum()) * len(words) / 2
    of = Kernel(words)
    landmarks = [*range(len(positive))[: LANDMARKS // 2], *range(len(positive), len(words))[: LANDMARKS // 2]]
    columns = np.stack([of.column(k) for k in landmarks], axis=1)
    values, vectors = np.linalg.eigh(columns[landmarks])
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = np.hstack([columns @ root, np.ones((len(words), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    active = np.ones(len(y), bool)
    for _ in range(30):
        xa = x[active] * cost[active, None]
        w = np.linalg.solve(ridge + xa.T @ x[active], xa.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return Model(of.collapsed(landmarks, root @ w[:-1]), float(w[-1]))


def fit_logistic(model: Model, features: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
    x = np.c_[features, np.ones(len(features))]
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + 0.05 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1]), gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    model.logistic = w


def held_out(row_id: Column) -> Column:
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_words(words: DataFrame, model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(model.value.words(names) if names else [], pa.float64())], ["word", "value"])

    return words.select("word").mapInArrow(run, "word string, value double")


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the labelled rows that are not held out; None where either class has no word.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; null labels and texts teach nothing, and of several
    labels of a row the highest counts.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = cut(usable.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")))
    part = lambda toxic, n: usable.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = part(1, TOXIC_DOCS).unionByName(part(0, CLEAN_DOCS))  # TOXIC_DOCS + CLEAN_DOCS pairs of numbers at most
    sample = cut(docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("text", "toxic"))
    split = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]+", "")))
    words = sample.select("toxic", F.explode(split).alias("word")).where(F.length("word").between(3, LONGEST))
    counts = cut(words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    all_sizes = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    ratio = (F.col("bad") / sizes[1]) / ((F.col("good") + 0.5) / sizes[0])
    marked = counts.where((F.col("bad") >= max(3, sizes[1] // 200)) & (ratio >= 8)).select("word", (F.col("bad") * F.log(ratio)).alias("w"))
    positive = {r.word: r.w for r in marked.orderBy(F.desc("w"), "word").limit(MARKERS).collect()}
    harmless = counts.where((F.col("good") > 0) & (ratio < 4)).select("word", (1 + F.log(F.col("good").cast("double"))).alias("w"))
    negative = {r.word: r.w for r in harmless.orderBy(F.desc("w"), "word").limit(COMMON).collect()}
    negative |= {r.word: r.w for r in harmless.orderBy(F.xxhash64("word"), "word").limit(RANDOM).collect()}
    if not positive or not negative:
        return None
    model = fit_machine(positive, negative)
    for _ in range(PASSES):
        shipped = spark.sparkContext.broadcast(model)
        hard = score_words(harmless, shipped).orderBy(F.desc("value"), "word").limit(HARD).join(harmless, "word").orderBy(F.desc("value"), "word").collect()
        negative = {r.word: r.w for r in hard} | negative
        model = fit_machine(positive, negative)
    shipped = spark.sparkContext.broadcast(model)
    rows = with_features(sample, shipped).select("toxic", "features").collect()  # TOXIC_DOCS + CLEAN_DOCS short rows at most
    toxic = np.array([r.toxic for r in rows])
    # the sampled shares of the classes are not those of the labels
    weight = np.where(toxic == 1, all_sizes[1] / sizes[1], all_sizes[0] / sizes[0])
    fit_logistic(model, np.array([r.features for r in rows]), toxic, weight * len(rows) / weight.sum())
    return model


def with_features(df: DataFrame, model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = model.value.features([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.tolist(), pa.list_(pa.float64()))], [*part.schema.names, "features"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))]))


def score(docs: DataFrame, model: Model | None, column: str = "score") -> DataFrame:
    """``docs`` with a toxicity of 0 to 1 for every row; only the text has a part in it.

    A null text is an empty one, and a text without words has the score of no word. Without a model (no labelled
    words of both classes) every score is 0. A column named as the score is replaced, and one named features is left
    out.
    """
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("features", column)
    z = F.lit(float(model.logistic[-1]))
    for k, w in enumerate(model.logistic[:-1]):
        z = z + F.lit(float(w)) * F.col("features")[k]
    return with_features(docs, shipped).withColumn(column, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))).drop("features")
