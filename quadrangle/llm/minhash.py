"""Near duplicates by fast similarity sketching, banding and exact verification.

A document is the set of its distinct word shingles (words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased). The sketch has
bands * rows coordinates: in round i every element is thrown into a hashed bin, and a bin keeps the smallest value of the
first round that reaches it; after as many rounds as bins, round i serves bin i alone, so every coordinate fills. Two sets
agree in a coordinate with probability equal to their Jaccard similarity, with the concentration of a full MinHash, at a
cost of a few hashes for each element. Documents that agree in all rows of a band are candidates; links are confirmed on
the full sets of 64-bit shingle hashes.

Defined cases: null or empty text, or text without a word, gives an empty set, which is linked with nothing. Rows with
equal sets are one class. A row with a null doc_id links like any other, so that chains over it hold; a component is named after its
smallest doc_id that is not null, null if it has none, and its rows without a doc_id are kept in that case only. Rows that share a doc_id
keep a row each, and each has the links of its own text; copies of a row are one node, and all are kept if their doc_id is the
component's. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c
from quadrangle.llm import rounds

BANDS, ROWS = 30, 5
#: Bytes of text that are worked on at once, with about a dozen numbers for each.
STEP_BYTES = 1 << 20
#: Words of 64 parity bits of a set.
PARITY = 8
WORD = r"[^\x20\x09-\x0D]"
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
NO_RANGE = np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after another, and their number for each row."""
    data = c.lower_bytes()[data]
    start, end, row = c.spans(data, offsets, c.blank_bytes())
    h = c.word_hash(data, start, end)
    n = len(offsets) - 1
    per_row = np.bincount(row, minlength=n)
    first = np.zeros(n + 1, np.int64)
    np.cumsum(per_row, out=first[1:])
    grams = h.copy()
    size = len(h)
    for k in range(1, words):  # a gram is the hash of up to `words` words from here on, within the row
        more = np.flatnonzero(np.arange(size) + k < first[1:][row]) if size else np.zeros(0, np.int64)
        grams[more] = c.mix(grams[more] * np.uint64(0x9E3779B97F4A7C15) + h[more + k])
    out, counts = [], np.zeros(n, np.int64)
    for i in range(n):
        if m := int(per_row[i]):
            g = np.sort(grams[first[i] : first[i] + max(1, m - words + 1)])
            g = g[np.concatenate(([True], g[1:] != g[:-1]))]
            out.append(g)
            counts[i] = len(g)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def sketches(values: np.ndarray, counts: np.ndarray, t: int) -> np.ndarray:
    """One row of t coordinates for each set; an empty set has EMPTY in all."""
    n = len(counts)
    flat = np.full(n * t, EMPTY, np.uint64)
    row = np.repeat(np.arange(n), counts)
    x, todo = values, counts > 0
    for i in range(t):
        h = np.minimum(c.mix(x + np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), EMPTY - NO_RANGE)
        at = row * t + ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        new = flat[at] == EMPTY
        np.minimum.at(flat, at[new], c.mix(h[new]) >> NO_RANGE)
        todo = todo & (flat.reshape(n, t) == EMPTY).any(axis=1)
        if not todo.any():
            break
        stay = todo[row]
        x, row = x[stay], row[stay]
    sk = flat.reshape(n, t)
    starts = np.concatenate(([0], np.cumsum(counts)))
    for r, b in zip(*np.nonzero((sk == EMPTY) & (counts > 0)[:, None]), strict=True):  # the rounds that serve one bin each
        seed = np.uint64((2 * (t + int(b)) + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        sk[r, b] = c.mix(values[starts[r] : starts[r + 1]] + seed).min() >> NO_RANGE
    return sk


def band_keys(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    v = sk.reshape(len(sk), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), v.shape[:2]).copy()
    for r in range(rows):
        key = c.mix(key * np.uint64(0xD6E8FEB86659FD93) + v[:, :, r])
    return key


def parities(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """PARITY words for each set: bit i tells whether an odd number of its elements has the upper hash bits i. Two sets differ in
    no more bits than they differ in elements."""
    bits = 64 * PARITY
    edges = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros((len(counts), PARITY), np.int64)
    for lo in range(0, len(counts), 4096):
        hi = min(lo + 4096, len(counts))
        own = values[edges[lo] : edges[hi]]
        at = np.repeat(np.arange(hi - lo), counts[lo:hi]) * bits + (own >> np.uint64(65 - bits.bit_length())).astype(np.int64)
        odd = (np.bincount(at, minlength=(hi - lo) * bits) & 1).astype(np.uint8)
        out[lo:hi] = np.packbits(odd).view(np.int64).reshape(hi - lo, PARITY)
    return out


def fingerprints(values: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """k1, k2 of each set: two sums of its hashed elements."""
    edges = np.concatenate(([0], np.cumsum(counts)))
    out = []
    for seed in (0x51, 0xA7C3):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(c.mix(values + np.uint64(seed)), out=total[1:])
        out.append(pa.array(c.signed(total[edges[1:]] - total[edges[:-1]])))
    return out


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, t (hash of the whole text), n_shingles, k1, k2 (fingerprint of the set), bands (keys; none for an empty set), parity."""

    @c.lean
    def run(batches):
        for b in batches:
            for lo, hi, data, off in c.steps(b.column(2), STEP_BYTES):
                values, counts = shingle_sets(data, off, words)
                keys = band_keys(sketches(values, counts, bands * rows), bands, rows)[counts > 0].ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(lo, hi - lo),
                        b.column(1).slice(lo, hi - lo),
                        pa.array(counts),
                        *fingerprints(values, counts),
                        c.list_array(pa.array(c.signed(keys)), np.where(counts > 0, bands, 0)),
                        c.list_array(pa.array(parities(values, counts).ravel()), np.full(hi - lo, PARITY)),
                    ],
                    ["doc_id", "t", "n_shingles", "k1", "k2", "bands", "parity"],
                )

    slim = docs.select(F.col("doc_id").cast("long"), c.text_hash().alias("t"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, t long, n_shingles long, k1 long, k2 long, bands array<long>, parity array<long>")


def set_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, z: a compressed text of each wanted set (id, doc_id, t). Rows alike in both keys send one text from each task, and the join, by
    sorting at any size, finds texts where that left them."""

    def keyed(df: DataFrame, value: str) -> DataFrame:  # null-safe keys as plain columns, so that grouping and join share one shuffle
        return df.select(F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"), "t", value)

    one = keyed(c.packed_texts(docs), "z").groupBy("d", "none", "t").agg(F.any_value("z").alias("z"))
    return one.join(keyed(wanted, "id").hint("merge"), ["d", "none", "t"]).select("id", "z")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union. Sets are made from their texts (id, z) in the task, as
    compressed texts are a fraction of their sets."""

    @c.lean
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress

        def members(z: bytes) -> np.ndarray:
            data = np.frombuffer(unpack(z), np.uint8)
            return shingle_sets(data, np.array([0, len(data)]), words)[0]

        last, p = None, EMPTY
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x = x.as_py()
                if x != last:
                    last, p = x, members(x)
                q = members(y.as_py())
                both = np.sort(np.concatenate((p, q)))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(p) + len(q) - same))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    # only texts of these pairs move, in the same way at any size
    used = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    left = used.select(F.col("id").alias("a"), F.col("z").alias("x")).hint("merge")
    right = used.select(F.col("id").alias("b"), F.col("z").alias("y")).hint("merge")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id), text_hash, group (a number of the
    component; components of texts that share a doc_id can have one component_id).

    What is linked are sets, whatever the doc_ids of their rows; buckets are worked off by rounds of leaders. Pairs whose sizes or
    parities rule out a link never leave the join, so documents that are only alike do not fill it with pairs: sets with
    100 * intersection >= percent * union differ in at most (n + m) * (100 - percent) / (100 + percent) elements.
    """
    own = c.Scratch(docs.sparkSession)
    sig = own.cut(signatures(docs, words, bands, rows))
    real = sig.where("n_shingles > 0")
    parity = [f"p{i}" for i in range(PARITY)]
    some = F.any_value(F.struct("n_shingles", "bands", "parity")).alias("s")
    sets = real.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("rep"), some)
    sets = own.cut(sets.select(F.monotonically_increasing_id().alias("id"), "k1", "k2", "rep.doc_id", "rep.t", F.col("s.n_shingles").alias("n"), "s.bands", "s.parity"))
    about = sets.select("id", "n", *(F.col("parity")[i].alias(p) for i, p in enumerate(parity)))
    members = rounds.with_sizes(own, sets.select(F.explode(F.array_distinct("bands")).alias("key"), "id"), about)
    differ = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"l_{p}"))) for p in parity), F.lit(0))
    possible = F.expr(f"100 * least(n, l_n) >= {percent} * greatest(n, l_n)") & (differ * (100 + percent) <= (F.col("n") + F.col("l_n")) * (100 - percent))
    texts = own.cut(set_texts(docs, sets.join(members.select("id").distinct(), "id").select("id", "doc_id", "t")))
    comps = rounds.components(own, members, ["n", *parity], possible, lambda pairs: confirmed(pairs, texts, words, percent))
    classes = sets.select("id", "k1", "k2", F.col("doc_id").alias("rep"))
    if comps is not None:
        classes = classes.join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        least = classes.groupBy("component").agg(F.min("rep").alias("least"))
        classes = classes.join(least, "component").select("k1", "k2", F.col("component").alias("group"), F.col("least").alias("component"))
    else:
        classes = classes.select("k1", "k2", F.col("id").alias("group"), F.col("rep").alias("component"))
    out = sig.select("doc_id", "t", "n_shingles", "k1", "k2").join(own.cut(classes), ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("t").alias("text_hash"), "group")
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    done = c.cut(out)
    own.clear()
    return done


def first_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, and of rows that share it that of the smallest text hash. Rows
    with a null doc_id or without a word stay. All columns are kept."""
    own = c.Scratch(docs.sparkSession)
    d, t = c.fresh("gone_id", docs), c.fresh("gone_text", docs)
    near = near_duplicates(docs, words, percent).where("n_shingles > 0 and doc_id is not null")
    first = own.cut(near.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")))
    gone = near.join(first, "group").where("doc_id <> first.doc_id or text_hash <> first.text_hash")
    gone = c.cut(gone.select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct())
    left = docs.join(gone, (docs["doc_id"].cast("long") == F.col(d)) & (c.text_hash() == F.col(t)), "left_anti")
    real = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(WORD)
    return c.one_each(c.Scratch(docs.sparkSession), left, docs, real)
