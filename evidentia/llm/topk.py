"""Exact top-k inner products, block at a time.

Vectors are packed, as integers, into groups of blocks of consecutive ids; a block has the largest and smallest value of every
term. A query orders a group's blocks by the sum of what each term could give at most, scores block after block through its
matrix, and stops when the next bound falls below its k-th score. Queries are packed as well. All pairs are laid out as a grid:
a cell has a bounded share of the queries, which its task holds, and a share of the groups, which stream past them and leave each
query's k best. What the cells return is merged by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import cut, shuffle_partitions

BLOCK, BLOCKS_IN_GROUP, QUERIES_IN_BATCH = 256, 32, 512
#: Queries that a task holds, and components of them; queries that are scored together.
HELD, HELD_VALUES, AT_ONCE = 8192, 1 << 22, 1024
#: A score is a long: one that is larger is this, up or down, and equal to all that are.
MOST = (1 << 63) - 1


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 * x) of every component: as 64-bit integers if all have room in them, else as integers of any size."""
    if np.abs(values).max(initial=0) < 1 << 54:
        return np.floor(values * 256).astype(np.int64)
    # a double of 2**53 or more is whole
    exact = [[math.floor(x) * 256 if abs(x) >= 1 << 53 else math.floor(x * 256) for x in row] for row in values.tolist()]
    return np.array(exact, object).reshape(values.shape)


def valid(vector: Column) -> Column:
    """No null, and nothing but finite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def held(scores: np.ndarray) -> np.ndarray:
    """Scores as a long holds them."""
    return (np.clip(scores, -MOST, MOST) if scores.dtype == object else scores).astype(np.int64)


def packed(rows: DataFrame, size: int) -> DataFrame:
    """(pack, ids, values, form, width): rows of up to ``size`` vectors of neighbouring ids, numbered within their partition.

    Shorter vectors are filled up with zeros, which add nothing to a product. The values are the smallest integers that hold them
    all, or the components themselves if 64 bits don't.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        vectors: list[list[float]] = []

        def lot() -> pa.RecordBatch:
            width = max(map(len, vectors))
            values = np.zeros((len(vectors), width), np.float64)
            for k, v in enumerate(vectors):
                values[k, : len(v)] = v
            whole = quantised(values)
            most = int(np.abs(whole).max(initial=0))
            form = "f8" if whole.dtype == object else next(f for f, bits in (("i2", 15), ("i4", 31), ("i8", 63)) if most < 1 << bits)
            raw = (values if form == "f8" else whole).astype(form).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([np.array(ids, np.int64).tobytes()]), pa.array([raw]), pa.array([form]), pa.array([width], pa.int32())], ["ids", "values", "form", "width"])

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                ids.append(i)
                vectors.append(v)
                if len(ids) == size:
                    yield lot()
                    ids, vectors = [], []
        if ids:
            yield lot()

    ordered = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "id").sortWithinPartitions("id")
    return ordered.mapInArrow(run, "ids binary, values binary, form string, width int").withColumn("pack", F.monotonically_increasing_id())


def matrix(raw: bytes, form: str, width: int, rows: int) -> np.ndarray:
    """Packed vectors as integers."""
    values = np.frombuffer(raw, form).reshape(rows, width)
    return quantised(values) if form == "f8" else values.astype(np.int64)


def share(of: int) -> Column:
    """Packs dealt over ``of`` shares, whichever partitions they are from."""
    partition, place = F.shiftright("pack", 33), F.col("pack").bitwiseAND((1 << 33) - 1)
    return F.pmod(partition + place, F.lit(of)).cast("int")


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Held:
    """The queries of a cell, with the k best vectors that each has met."""

    def __init__(self, batches: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
        wide = max(v.shape[1] for _, v in batches)
        self.k, self.ids = k, np.concatenate([i for i, _ in batches])
        self.values = np.concatenate([np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for _, v in batches])
        self.forms: dict[type, np.ndarray] = {}
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(self.ids)
        #: The k-th score of each query, below all scores as long as there is none.
        self.last = np.full(len(self.ids), -MOST - 1, np.int64)

    def meet(self, ids: np.ndarray, values: np.ndarray) -> None:
        """The vectors of a group, pruned block by block; a query's own id is left out. Vectors are compared over the shorter."""
        width = min(self.values.shape[1], values.shape[1])
        values = values[:, :width]
        # sums of products below 2**53 are exact in floating point, which is faster
        reach = int(np.abs(self.values).max(initial=0)) * int(np.abs(values).max(initial=0)) * max(1, width)
        form = np.float64 if reach < 1 << 53 else np.int64 if reach < 1 << 63 else object
        if form not in self.forms:
            self.forms[form] = self.values.astype(form)
        every, values = self.forms[form][:, :width], values.astype(form)
        starts = np.arange(0, len(ids), BLOCK)
        high, low = np.maximum.reduceat(values, starts, axis=0), np.minimum.reduceat(values, starts, axis=0)
        for first in range(0, len(every), AT_ONCE):
            queries, last = every[first : first + AT_ONCE], self.last[first : first + AT_ONCE]
            bounds = held(np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T)
            order = np.argsort(-bounds, axis=1, kind="stable")
            waiting = np.arange(len(queries))
            for turn in range(len(starts)):
                block = order[waiting, turn]
                # the k-th score may be shared, and the smaller id wins
                open_ = bounds[waiting, block] >= last[waiting]
                waiting, block = waiting[open_], block[open_]
                if not len(waiting):
                    break
                for b in np.unique(block):
                    own, part = waiting[block == b], slice(starts[b], starts[b] + BLOCK)
                    scores = held(queries[own] @ values[part].T)
                    for row in np.flatnonzero(scores.max(axis=1) >= last[own]):
                        q = own[row]
                        self.take(first + q, ids[part], scores[row])

    def take(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        use = (ids != self.ids[q]) & (scores >= self.last[q])
        have, had = self.found[q]
        self.found[q] = have, had = best_of(np.concatenate((have, ids[use])), np.concatenate((had, scores[use])), self.k)
        if len(had) == self.k:
            self.last[q] = had[-1]

    def result(self) -> pa.RecordBatch:
        columns = np.repeat(self.ids, [len(i) for i, _ in self.found]), np.concatenate([i for i, _ in self.found]), np.concatenate([s for _, s in self.found])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def top_k(rows: DataFrame, is_query: Column, k: int = 5, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query, ties to the smaller id.

    Queries are the rows for which ``is_query`` holds, candidates all rows but the query's own id. Rows whose vector or
    id is null, or with a component that is null or not finite, take no part; an empty vector scores 0. Vectors of
    unequal lengths are compared over the shorter. Components of any finite size count whole; a score that a long can not hold is
    the largest, or smallest but one, that it can, and ties with others like it. Rows that repeat an id are one candidate each for
    other queries. An empty table, or one row, gives none.
    """
    usable = rows.where(F.col(row_id).isNotNull() & valid(F.col(vector)))
    candidates = usable.select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = usable.where(is_query).select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).dropDuplicates(["id"])
    # a group of blocks is one row of about BLOCK * BLOCKS_IN_GROUP vectors
    groups, batches = cut(packed(candidates, BLOCK * BLOCKS_IN_GROUP)), cut(packed(asked, QUERIES_IN_BATCH))
    n_groups = groups.count()
    n_batches, n_queries, wide = batches.agg(F.count("*"), F.sum(F.length("ids") / 8).cast("long"), F.max("width")).first()
    if not n_groups or not n_batches:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # as many cells as partitions, and more where a cell would hold too many queries
    down = min(n_batches, -(-n_queries // max(1, min(HELD, HELD_VALUES // max(1, wide)))))
    across = max(1, min(n_groups, -(-shuffle_partitions(rows.sparkSession) // down)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["ids", "values", "form", "width", "pack"]
    dealt = batches.select(*columns, F.lit(0).alias("side"), share(down).alias("row"), each(across).alias("at"))
    dealt = dealt.unionByName(groups.select(*columns, F.lit(1).alias("side"), share(across).alias("at"), each(down).alias("row")))
    # both sides of a cell in one stream, its queries first: no join, so nothing that is repeated is broadcast
    dealt = dealt.withColumn("cell", F.col("row") * across + F.col("at")).drop("row", "at")
    grid = dealt.repartitionById(down * across, F.col("cell")).sortWithinPartitions("cell", "side", "pack")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, met = None, [], None
        for part in parts:
            for row in range(part.num_rows):
                at = {n: part.column(n)[row].as_py() for n in part.schema.names}
                if at["cell"] != cell:
                    if met:
                        yield met.result()
                    cell, waiting, met = at["cell"], [], None
                ids = np.frombuffer(at["ids"], np.int64)
                values = matrix(at["values"], at["form"], at["width"], len(ids))
                if at["side"] == 0:
                    waiting.append((ids, values))
                elif waiting or met:
                    met = met or Held(waiting, k)
                    waiting = []
                    met.meet(ids, values)
        if met:
            yield met.result()

    local = grid.mapInArrow(run, "query_id long, vec_id long, score long")
    # k rows a query from each cell; a query's are merged in two steps
    merged = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k).alias("best")
    partly = local.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("part")).agg(merged).select("query_id", F.explode("best").alias("x"))
    ranked = partly.select("query_id", (-F.col("x.less")).alias("score"), "x.vec_id").groupBy("query_id").agg(merged)
    return ranked.select("query_id", F.posexplode("best").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.less")).alias("score")
    )
