"""Token ids in ORC files: stripes of run-length encoded integers with row indexes and Bloom filters on document ids.

Documents are dealt by ranges of doc_id and sorted within a file, so file order is document order. A row holds a document's
ids with the end id; `part` and `start` place it in its file, and the sums of `n_tokens` by part, which are read from that
column alone, place the files. The ORC writer run-length encodes integers and keeps minima, maxima and a Bloom filter of
doc_id for every `ROW_INDEX` rows, so a lookup of doc_ids skips files, stripes and row groups from metadata, and a full
read is split by stripes.

Encoding is done unit by unit: a unit is what stands between spaces and line feeds, where the word tokenizer starts anew,
and a worker keeps the ids of the units that it has seen, by a 64-bit hash. A new unit that is a word of Latin letters is merged by
the library's model; any other goes through the whole library.

Defined cases: null text is empty, and its ids are the end id alone. Null doc_ids come first. Rows that repeat a doc_id are
ordered by a hash of their text. Other columns of `documents` are ignored.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrangle.llm import common as c
from quadrangle.llm.units import DOTTED_I, Units, as_shown, in_order, last_signs, latin_word

STRIPE_BYTES, ROW_INDEX, BLOOM_FPP = 16 << 20, 1000, 0.01
END = 1
#: Units that a worker remembers.
UNITS = 1 << 19


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def _word(unit: str) -> str | None:
    """Letters up to U+024F, but U+0130, have one lower-case form each and stay as they are in composition."""
    if not latin_word(unit) or DOTTED_I in unit:
        return None
    unit = unit.lower()
    return unit if unit.isascii() else as_shown(unit)


@functools.cache
def worker_units(path: str, end_id: int) -> Units:
    """One memory for all tasks of a worker process."""
    return Units(path, _word, [end_id], UNITS)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each unit with A-Z in lower case, and whether it was taken like that: a unit with a '<' (a special token could
    begin) or a character from U+0300 on (it could compose with a letter) is hashed as it is."""
    special = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data >= 0xCC) | (data == 0x3C), out=special[1:])
    plain = special[end] == special[start]
    h = c.word_hash(c.lower_bytes()[data], start, end)
    if not plain.all():
        odd = np.flatnonzero(~plain)
        h[odd] = ~c.word_hash(data, start[odd], end[odd])
    return h, plain


@functools.cache
def _breaks() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x0A, 0x20]] = True
    return t


def encode_bytes(units: Units, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts (UTF-8), one after another, each with its end id, and how many each has."""
    start, end, row = c.spans(data, offsets, _breaks())
    sign = last_signs(data, start, end)
    end = end - (sign > 0)
    h, plain = _hashes(data, start, end)

    def text_of(at: np.ndarray) -> list[str]:
        raw, low = data.tobytes(), c.lower_bytes()[data].tobytes()
        return [(low if p else raw)[a:b].decode() for a, b, p in zip(start[at].tolist(), end[at].tolist(), plain[at].tolist(), strict=True)]

    unit, per_row = in_order(units.codes(h, text_of), sign, row, len(offsets) - 1, True)
    flat, ends = units.gather(unit)
    return flat, np.diff(ends[np.cumsum(per_row) - 1], prepend=0)


def _encode(rows: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, part, start (ids before it in its part), n_tokens, ids; the order of rows stays."""

    def run(batches):
        part, before, units = TaskContext.get().partitionId(), 0, worker_units(path, end_id)
        for b in batches:
            for lo, hi, data, off in c.steps(b.column(1)):
                flat, n = encode_bytes(units, data, off)
                start = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)), pa.array(start), pa.array(n), c.list_array(pa.array(flat), n)],
                    ["doc_id", "part", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(run, "doc_id long, part int, start long, n_tokens long, ids array<int>")


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END) -> None:
    """Writes the ids of every row of docs to ORC files in the folder, in ascending doc_id order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    _encode(dealt, path or vocabulary(), end_id).write.options(
        **{
            "compression": "zstd",
            "orc.stripe.size": STRIPE_BYTES,
            "orc.row.index.stride": ROW_INDEX,
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": BLOOM_FPP,
        }
    ).orc(folder)


def read_ids(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids from the files. With doc_ids (a short list), only those
    documents are read, by metadata where it can tell."""
    rows = spark.read.schema("doc_id long, part int, start long, n_tokens long, ids array<int>").orc(folder)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each file, so small enough to broadcast
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    return rows.join(F.broadcast(base), F.col("part") == F.col("p")).select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")


def with_crc32(rows: DataFrame, name: str = "ids_crc32") -> DataFrame:
    """rows with the unsigned crc32 of `ids` as little-endian unsigned 32-bit integers in place of them."""

    @F.arrow_udf("long")
    def crc(ids: pa.Array) -> pa.Array:
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        size = np.diff(ids.offsets.to_numpy())
        at = np.concatenate(([0], np.cumsum(size)))
        return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())

    return rows.withColumn(name, crc("ids")).drop("ids")
