"""Plain Lloyd clustering of integer vectors.

The centroids, at most `K` rows, are broadcast. In every round `mapInPandas` holds a batch of vectors against one centroid after the
other in NumPy: integer squared differences, the argmin takes the lowest index. A task adds up its vectors by cluster and emits at most K
rows of exact integer sums, which one groupBy merges, so a round shuffles K rows a task and the driver receives K. A new centroid is
the floor of sum over count in Python integers; a centroid without vectors stays. Every step is exact, so results do not depend on
partitions or order.

Vectors are read and made integer once, into a table that every round reads.

Defined cases: vectors that are null, have another number of components or hold a null or non-finite one take no part. A null vec_id
takes part and hashes as an empty string. Rows that repeat a vec_id are vectors each; equal hashes are ordered by the vectors'
components. With fewer vectors than centroids there are as many centroids as vectors; an empty table has no result. Components count
as at most 2**27 from zero after scaling, which keeps every distance below 2**63; sums of distances beyond that stay at 2**63 - 1.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c

K, ROUNDS, WIDTH, SCALE = 16, 3, 64, 64
LARGEST = 1 << 27
#: Vectors that are compared at a time.
STEP = 8192


def integer_vectors(rows: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of int) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    fine = (F.size(x) == width) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(x, lambda e: F.greatest(F.least(F.floor(e * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return rows.where(F.col("embedding").isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of seed:vec_id."""
    name = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(name.alias("name"), "v").orderBy("name", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centroid (of equal ones the lowest) and the squared distance."""
    d = np.empty((len(centroids), len(x)), np.int64)
    for j, centre in enumerate(centroids):
        diff = x - centre
        d[j] = np.einsum("ij,ij->i", diff, diff)
    best = d.argmin(axis=0)
    return best, d[best, np.arange(len(x))]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for b in batches:
        for lo in range(0, len(b), STEP):
            part = b.iloc[lo : lo + STEP]
            yield part, np.stack(part["v"].to_numpy()).astype(np.int64)


def _moved(vectors: DataFrame, centroids: np.ndarray, known: Broadcast) -> np.ndarray:
    """The centroids after one round."""
    k, width = centroids.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, x in _blocks(batches):
            cluster, _ = nearest(x, known.value)
            n += np.bincount(cluster, minlength=k)
            for j in np.unique(cluster):
                sums[j] += x[cluster == j].sum(axis=0)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": some.astype(np.int32), "n": n[some], "sums": list(sums[some])})

    parts = vectors.select("v").mapInPandas(run, "cluster int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():
        out[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return out


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """The centroids after so many rounds; vectors as integer_vectors() makes them. One row for each centroid."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        known = vectors.sparkSession.sparkContext.broadcast(centroids)
        centroids = _moved(vectors, centroids, known)
        known.destroy()
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    known = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _blocks(batches):
            cluster, distance = nearest(x, known.value)
            yield pd.DataFrame({"id": part["id"], "known": part["known"], "cluster": cluster.astype(np.int32), "distance": distance})

    # a null in a column of integers would make them floating-point numbers in pandas
    rows = vectors.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNotNull().alias("known"), "v")
    out = rows.mapInPandas(run, "id long, known boolean, cluster int, distance long")
    return out.select(F.when(F.col("known"), F.col("id")).alias("vec_id"), "cluster", "distance")


def cluster(rows: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 1, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector of rows (vec_id, embedding)."""
    spark, own = rows.sparkSession, c.Scratch(rows.sparkSession)
    vectors = own.cut(integer_vectors(rows, width, scale))
    centroids = fit(vectors, k, rounds, seed)
    if not len(centroids):
        own.clear()
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    assigned = c.cut(assign(vectors, centroids))
    own.clear()
    sums = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    most = (1 << 63) - 1
    known = [(j, min(d, most), min(sum(sums.values()), most), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, d in sums.items()]
    totals = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows at most
    return assigned.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
