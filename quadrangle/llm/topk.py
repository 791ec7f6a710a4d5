"""Exact top-k search by inner product with a pivot table.

Vectors are integers floor(scale * x). Every row's distances to `PIVOTS` pivots are computed once and stored with it. For a
query the largest difference of two distances to one pivot is a lower bound of the distance d, and
q.x = (|q|^2 + |x|^2 - d^2) / 2 turns it into an upper bound of the score. In each block of rows candidates are evaluated in
the order of their bounds; the block is done when the next bound is below the k-th best score so far. Scores are integers,
bounds are widened by more than their rounding error, and equal bounds are evaluated, so ties are exact.

Queries go out in blocks of about `QUERY_BLOCK`, one after another: a bounded broadcast, which meets all rows where they lie and
is given up when its results are written; a task returns at most k rows for each query. Pivots come from a bounded sample: of the `SAMPLE` rows with the smallest hash of
vec_id those farthest from each other.

Defined cases: vectors that are null or hold a null or non-finite component take no part, neither do null vec_ids; shorter
vectors count as padded with zeros; an empty table has no result. Rows that repeat a vec_id are candidates each; as a query
the smallest of them counts, and none of them is its candidate. Scores must fit 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.llm import common as c

PIVOTS, SAMPLE, QUERY_BLOCK = 32, 1024, 4096


def integer_vectors(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v (array of long) of the rows that take part."""
    parts = F.col("embedding").cast("array<double>")
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    return some.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(parts, lambda x: F.floor(scale * x)).alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """One row for each list, padded with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(lists.offsets.to_numpy())
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def farthest_first(vectors: np.ndarray, count: int) -> np.ndarray:
    """Rows that are each the farthest from those before."""
    x = vectors.astype(float)
    chosen, near = [0], np.full(len(x), np.inf)
    while len(chosen) < min(count, len(x)):
        near = np.minimum(near, np.linalg.norm(x - x[chosen[-1]], axis=1))
        chosen.append(int(near.argmax()))
    return vectors[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = x.astype(float), pivots.astype(float)
    return np.stack([np.linalg.norm(x - row, axis=1) for row in p], axis=1)


def with_pivots(vectors: DataFrame, width: int, pivots: int, sample: int) -> DataFrame:
    """vectors with `t`, the distances to the pivots."""
    rows = c.some_rows(vectors, "vec_id", sample, 5).toArrow()
    chosen = farthest_first(_matrix(rows.column("v"), width), pivots)

    def run(batches):
        for b in batches:
            t = distances(_matrix(b.column(1), width), chosen)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), c.list_array(pa.array(t.ravel()), np.full(len(t), t.shape[1]))], ["vec_id", "v", "t"])

    return vectors.mapInArrow(run, "vec_id long, v array<long>, t array<double>")


class Best:
    """The k best (score, vec_id) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score: list[np.ndarray] = [np.zeros(0, np.int64)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * queries
        self.least = np.full(queries, -np.inf)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate((self.score[q], score)), np.concatenate((self.ids[q], ids))
        top = np.lexsort((ids, -score))[: self.k]
        self.score[q], self.ids[q] = score[top], ids[top]
        if len(top) == self.k:
            self.least[q] = score[top[-1]]


def upper_bounds(tq: np.ndarray, nq: np.ndarray, tx: np.ndarray, nx: np.ndarray) -> np.ndarray:
    """Of the scores of all queries (rows) with all candidates (columns)."""
    low = np.zeros((len(tq), len(tx)))
    for j in range(tq.shape[1]):
        np.maximum(low, np.abs(tq[:, j, None] - tx[None, :, j]), out=low)
    both = nq[:, None] + nx[None, :]
    return (both - low * low) / 2 + 1e-9 * both + 1


def search_block(best: Best, qid: np.ndarray, q: np.ndarray, bounds: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
    """Candidates in the order of their bounds, until the next bound is below the k-th best score."""
    small = max(np.abs(q).max(initial=0), 1) * float(max(np.abs(x).max(initial=0), 1)) * q.shape[1] < 2**52
    xs, qs = (x.astype(float), q.astype(float)) if small else (x, q)  # exact in either type
    for i in range(len(q)):
        some = np.flatnonzero((bounds[i] >= best.least[i]) & (ids != qid[i]))
        some = some[np.argsort(-bounds[i, some], kind="stable")]
        at, step = 0, 8 * best.k
        while at < len(some) and bounds[i, some[at]] >= best.least[i]:
            take = some[at : at + step]
            best.add(i, (xs[take] @ qs[i]).astype(np.int64), ids[take])
            at, step = at + step, step * 2


def _search(index: DataFrame, known: Broadcast, width: int, k: int, rows_at_once: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        qid, q, tq = known.value
        nq = (q.astype(float) ** 2).sum(axis=1)
        best = Best(len(q), k)
        for b in batches:
            for lo in range(0, len(b), rows_at_once):
                part = b.slice(lo, rows_at_once)
                ids, x, tx = part.column(0).to_numpy(), _matrix(part.column(1), width), np.stack(part.column(2).to_numpy(zero_copy_only=False))
                bounds = upper_bounds(tq, nq, tx, (x.astype(float) ** 2).sum(axis=1))
                search_block(best, qid, q, bounds, ids, x)
        for i in range(len(q)):
            if n := len(best.ids[i]):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, qid[i])), pa.array(best.ids[i]), pa.array(best.score[i])], ["query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_id long, vec_id long, score long")


def search(rows: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, pivots: int = PIVOTS, sample: int = SAMPLE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest inner product for each row with is_query."""
    spark = rows.sparkSession
    vectors = c.cut(integer_vectors(rows, scale))
    n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = c.cut(with_pivots(vectors, width, pivots, sample).repartition(parts))
    asked = index.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "t")).alias("x"))
    asked = c.cut(asked.select("vec_id", "x.v", "x.t"))
    blocks = -(-asked.count() // query_block)
    found = []
    for number in range(blocks):  # one block at a time: the driver and the executors hold one, and its best rows go to a table
        block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).toArrow()
        if len(block):
            held = (block.column("vec_id").to_numpy(), _matrix(block.column("v"), width), np.stack(block.column("t").to_numpy()))
            known = spark.sparkContext.broadcast(held)
            found.append(c.cut(_search(index, known, width, k, max(64, (1 << 22) // len(block)))))
            known.destroy()
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = functools.reduce(DataFrame.unionByName, found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
