"""Conflict-constrained best-fit packing of documents into bins of fixed size.

A document of more than `capacity` code points is cut into pieces: full ones, which fill a bin each, and the rest. Within
a shard of about `shard_rows` documents, taken from the largest piece to the smallest, each piece goes to the open bin
with the smallest residual that can hold it and has no conflict: a bin carries a bitmap of its sources and one of its
duplicate clusters, and the search steps from bin to bin in the order of residuals until the tightest compatible one is
found; if there is none, a bin is opened. A bin never holds two pieces of one duplicate cluster or of one source. Bitmaps
are as long as the shard has sources and clusters, so a bit stands for one value only.

Shards are dealt by a hash of doc_id, text and the row's number, and their count follows the number of rows, so a source, a cluster
or a doc_id with a third of all rows is spread evenly, and a shard is about `shard_rows` documents whatever the keys.

Defined cases: null or empty text is one piece of size 0, which still takes a place in a bin. A null source, or a missing
source column, conflicts with nothing. Without a cluster column, equal texts are one cluster, and so are near copies where
`clusters` tells them, as in the query; an empty text is in none.
Ties go to the smaller (doc_id, piece); repeated rows are packed each, in shards of their own. Other columns are ignored.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c

CAPACITY, SHARD_ROWS = 16384, 2048


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every piece, in the given order. Source or cluster -1 conflicts with nothing."""
    order: list[tuple[int, int]] = []  # (residual, bin) of the open bins, sorted
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, d = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        at = bisect.bisect_left(order, (size, -1))
        while at < len(order) and (source_bits[order[at][1]] & s or cluster_bits[order[at][1]] & d):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
        else:
            residual, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        bins.append(b)
        offsets.append(capacity - residual)
        source_bits[b] |= s
        cluster_bits[b] |= d
        bisect.insort(order, (residual - size, b))
    return bins, offsets


def _pack_shard(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        codes = [pd.factorize(pdf[x])[0].tolist() for x in ("source", "cluster")]
        pdf["bin"], pdf["offset"] = best_fit(pdf["size"].tolist(), *codes, capacity)
        return pdf[["doc_id", "piece", "start", "size", "shard", "bin", "offset"]]

    return run


def pack(
    docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, cluster: Column | None = None, clusters: DataFrame | None = None
) -> DataFrame:
    """doc_id, piece (from 0), start (code point in the text), size (code points), shard, bin (in the shard), offset (in the bin).

    clusters: text_hash, cluster (a text's hash) of the texts whose cluster is not their own hash, if there is no cluster column."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    if cluster is None:
        cluster = F.when(F.length(text) > 0, c.text_hash())
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    shards = max(1, -(-docs.count() // shard_rows))
    shard = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), c.text_hash(), F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), cluster.cast("long").alias("cluster"), F.length(text).alias("n"), shard.alias("shard"))
    # a table, so that a row's number, which spreads rows that are alike, stays what it is; and lengths, not texts, go through the join
    slim = c.cut(slim)
    if clusters is not None:
        near = clusters.toDF("text_hash", "near")
        slim = slim.join(near, F.col("cluster") == F.col("text_hash"), "left")
        slim = slim.withColumn("cluster", F.coalesce("near", "cluster")).drop("text_hash", "near")
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(capacity))
    pieces = slim.select("*", F.posexplode(starts).alias("piece", "start")).withColumn("size", F.least(F.col("n") - F.col("start"), F.lit(capacity)))
    return pieces.drop("n").groupBy("shard").applyInPandas(
        _pack_shard(capacity), "doc_id long, piece int, start int, size int, shard int, bin int, offset int"
    )
