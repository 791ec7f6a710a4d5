"""Shared helpers: tables in the shared folder, connected components, and vectorised text hashing for Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadrangle.sources.scratch import shared_folder

#: Bytes of text that one vectorised step works on; a longer document is a step of its own.
STEP_BYTES = 1 << 21
#: Spark's switch for removing an execution's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/quadrangle/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


class Scratch:
    """Tables in the shared folder: each cuts the lineage and survives lost executors. The shuffle files that made a table go as soon
    as it is written, and a table goes with drop() or clear()."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def measured(self, df: DataFrame, *more: Column) -> tuple[DataFrame, dict]:
        """df as a table, its row count `n` and more aggregates, all found by the job that writes it."""
        seen = Observation()
        out = self.cut(df.observe(seen, F.count(F.lit(1)).alias("n"), *more))
        return out, seen.get

    def cut(self, df: DataFrame) -> DataFrame:
        path, before = scratch_path(self.spark), self.spark.conf.get(SHUFFLE_CLEANUP)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for frame in frames:
            if frame is not None and id(frame) in self.paths:
                path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(frame))[1])
                path.getFileSystem(conf).delete(path, True)

    def clear(self) -> None:
        self.drop(*(frame for frame, _ in list(self.paths.values())))


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder that stays until the folder is cleared."""
    return Scratch(df.sparkSession).cut(df)


def text_hash() -> Column:
    """A hash of the whole text (null as empty). With doc_id it is a row's key: rows that share both are alike."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def one_each(own: Scratch, docs: DataFrame, source: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """docs with one row for each doc_id and text; of rows that meet `where`, if given. Whole rows meet a shuffle only where some are
    alike, which is looked up in source (docs, or what they were taken from)."""
    source = docs if source is None else source
    d, t = fresh("d", docs), fresh("t", docs)
    keys = (source if where is None else source.where(where)).select(F.col("doc_id").cast("long").alias("a_d"), text_hash().alias("a_t"))
    alike = own.cut(keys.groupBy("a_d", "a_t").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    if not alike.take(1):
        return docs
    keyed = docs.withColumns({d: F.col("doc_id").cast("long"), t: text_hash()})
    same = F.col(d).eqNullSafe(F.col("a_d")) & (F.col(t) == F.col("a_t"))
    return keyed.join(alike, same, "left_anti").unionByName(keyed.join(alike, same, "left_semi").dropDuplicates([d, t])).select(docs.columns)


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the text), z: the text compressed, for a shuffle; null is empty."""

    @lean
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(t.as_py().encode()) for t in b.column(2)], pa.binary())], ["doc_id", "t", "z"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text_hash().alias("t"), text.alias("text")).mapInArrow(run, "doc_id long, t long, z binary")


def fresh(base: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base.lower() in taken:
        base += "_"
    return base


def some_rows(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """At most n rows: those whose key (a bigint) has the smallest hashes. Keys alone are sorted, so what meets in one task does not grow
    with the rows' size; the chosen keys, n at most, are broadcast."""
    at = fresh("chosen", rows)
    keys = rows.select(F.col(key).cast("long").alias(at)).where(F.col(at).isNotNull())
    chosen = keys.orderBy(F.xxhash64(at, F.lit(seed)), at).limit(n).distinct()
    return rows.join(F.broadcast(chosen), F.col(key).cast("long") == F.col(at), "left_semi").limit(n)


def components(own: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: edges (a, b) give rows (node, component), component the smallest node.

    Alternates large-star and small-star rounds. Minima are combined before each shuffle, and a node with very many
    neighbours meets a join with a single row per node, which Spark can split. Only a count and a checksum reach the driver.
    Nodes without an edge have no row; null ends and loops are ignored.
    """
    check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("check")
    first = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e, now = own.measured(first.distinct(), check)
    before = None
    while now != before and now["n"]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, before = e, now
        e, now = own.measured(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), check)
        own.drop(last)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def release() -> None:
    """Gives memory that this process has freed back to the system; allocators keep it else."""
    if _powers and len(_powers[0]) > 2 * STEP_BYTES:  # of a very long text
        _powers.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a task's function over Arrow batches, ending with release(). Python workers wait for further tasks, more of them than an
    executor has cores, and each would keep the memory of the largest step it has done."""

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


# ---------------------------------------------------------------- text as bytes


def steps(column: pa.Array | pa.ChunkedArray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of a string column; null counts as empty. Offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on a uint64 array."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**0.. and B**-0.. modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n + n // 8, 1 << 16)
        both = []
        for base in (_BASE, _BASE_INV):
            p = np.full(size, base, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i], times B**-i, a polynomial hash of data[i:j] that depends on the bytes alone."""
    out = np.zeros(len(data) + 1, U)
    if len(data):
        np.cumsum(_byte_values()[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; the length enters, so that spans of different length differ."""
    inv = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U) * U(0xA24BAED4963EE407))


#: Bytes up to which span_hash alone names a word. A polynomial modulo 2**64 is the same for some long strings of a regular build.
EXACT_BYTES = 64


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: spans of data, most of them short; long ones get a hash without structure."""
    h = span_hash(prefix_hash(data), start, end)
    long = np.flatnonzero(end - start > EXACT_BYTES)
    if len(long):
        raw = data.tobytes()
        h[long] = [xxhash.xxh3_64_intdigest(raw[a:b], 1) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return h


@functools.cache
def blank_bytes() -> np.ndarray:
    """True for the bytes that separate words: 0x20 and 0x09 to 0x0D."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


@functools.cache
def lower_bytes() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    return t


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs without a separator byte; runs never cross rows."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[data]
    edge = np.zeros(n + 2, bool)  # edge[i + 1]: a row starts at byte i
    edge[offsets + 1] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[1:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[2:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)


def binary_array(blob: bytes | np.ndarray, sizes: np.ndarray) -> pa.Array:
    off = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=off[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(off), pa.py_buffer(blob)])
