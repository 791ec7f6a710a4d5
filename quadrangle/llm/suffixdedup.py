"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A byte is removed when a string of `width` bytes that covers it also starts elsewhere in the corpus.

1. Every window of `width` bytes is named by its anchor, the k-gram in it with the smallest hash (the leftmost of equal
   ones). Neighbouring windows with one anchor form a span. Equal windows have equal anchors at equal offsets, so only
   spans whose anchor occurs twice or more can hold a repeat. Counting anchors combines before the shuffle.
2. Equal spans are one string with a weight. Their texts are dealt by anchor, so all copies of a window meet in one task.
   An anchor with more than `HOT_STRINGS` different spans (a passage that very many documents share, in different
   surroundings) is dealt by finer keys: runs of eight windows with their common bytes, then single windows.
3. In a task, blocks of whole anchors are cut into shards. Each shard has its own suffix order and Burrows-Wheeler
   transform over an alphabet of `width / STEPS`-byte symbols, taken at every byte. The shards' transforms are merged by
   interleave refinement: starting from any interleave, each round reads the transforms in the order of the last one and
   deals them stably by symbol, which sorts the interleave by one more symbol. The round that parts two neighbours is
   their common prefix; what is not parted after STEPS rounds is a repeated interval of `width` bytes. No suffix is
   compared with another one or sorted again.
4. Repeated windows go back to all copies of their span and are united in each document.

Symbols are 64-bit hashes of their bytes, as are the names of anchors and spans.

Defined cases: null text is empty; texts shorter than `width` keep all bytes. Strings do not cross rows; overlaps in one
row count as elsewhere. A row is known by its doc_id and a hash of its text, so rows that share a doc_id, or have none, have
intervals of their own, and rows alike in both are copies like any others. Other columns are kept by `cut_repeats` and
ignored by the rest.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c

WIDTH, GRAM, STEPS = 200, 40, 4
HOT_STRINGS = 2000
CHUNK = 8
#: Bytes of span text in a block, and shards that a block is cut into.
BLOCK_BYTES, SHARDS = 1 << 20, 4
#: Bytes of text whose windows are named in one step.
STEP_BYTES = 1 << 19


def spans_of(data: np.ndarray, offsets: np.ndarray, width: int, gram: int):
    """Row, first window, number of windows, anchor's place, anchor's hash and the text's prefix hash, of all spans."""
    prefix = c.prefix_hash(data)
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none, none.view(np.uint64), prefix
    inv = c.powers(n + 1)[1]
    grams = c.mix((prefix[gram:] - prefix[:-gram]) * inv[: n + 1 - gram])
    # the upper half of a hash, then the place: the same choice in equal windows, wherever they stand
    low = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    need, have = width - gram + 1, 1
    while have < need:
        step = min(have, need - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - width + 1, 0))
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    at = np.arange(len(row_of)) + np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    mine = anchor[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (mine[1:] != mine[:-1]) | (row_of[1:] != row_of[:-1])
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, len(at)))
    return row_of[first], at[first], size, mine[first], grams[mine[first]], prefix


def anchors(docs: DataFrame, width: int, gram: int, full: bool) -> DataFrame:
    """The anchor `a` of every span; if full, also doc_id, t (hash of the whole text), `at` (first window << 32 | bytes from there to the anchor << 16 | number of windows) and `s`, the span's name."""

    @c.lean
    def run(batches):
        for b in batches:
            for lo, _, data, off in c.steps(b.column(2), STEP_BYTES):
                row, first, size, place, a, prefix = spans_of(data, off, width, gram)
                out = [pa.array(c.signed(a))]
                if full:
                    s = c.mix(c.span_hash(prefix, first, first + size + width - 1) + a)
                    at = (first - off[row]) << 32 | (place - first) << 16 | size
                    out += [b.column(0).take(pa.array(lo + row)), b.column(1).take(pa.array(lo + row)), pa.array(at), pa.array(c.signed(s))]
                yield pa.RecordBatch.from_arrays(out, ["a", "doc_id", "t", "at", "s"][: len(out)])

    slim = docs.select(F.col("doc_id").cast("long"), c.text_hash().alias("t"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "a long, doc_id long, t long, at long, s long" if full else "a long")


def batches_of(rows: Iterator[tuple], kinds: dict[str, pa.DataType], most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most so many."""
    while part := list(itertools.islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*part, strict=True), kinds.values(), strict=True)], list(kinds))


def span_texts(docs: DataFrame, named: DataFrame, width: int) -> DataFrame:
    """s, key, o (bytes from the first window to the anchor), m (copies) and text of the spans in named (doc_id, t, at, s, a, m)."""

    kinds = {"s": pa.int64(), "key": pa.int64(), "o": pa.int32(), "m": pa.int64(), "text": pa.binary()}

    def pieces(b: pa.RecordBatch, z: zstandard.ZstdDecompressor) -> Iterator[tuple]:
        for packed, spans in zip(b.column(0), b.column(1), strict=True):
            text = z.decompress(packed.as_py())
            for x in spans.as_py():
                first, o, size = x["at"] >> 32, x["at"] >> 16 & 0xFFFF, x["at"] & 0xFFFF
                yield x["s"], x["a"], o, x["m"], text[first : first + size + width - 1]

    @c.lean
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            yield from batches_of(pieces(b, z), kinds)

    per_text = named.groupBy(F.col("doc_id").alias("d"), F.col("t").alias("d_t")).agg(F.collect_list(F.struct("at", "s", "a", "m")).alias("spans"))
    joined = c.packed_texts(docs).join(per_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("d_t")))
    return joined.select("z", "spans").mapInArrow(run, "s long, key long, o int, m long, text binary")


# ---------------------------------------------------------------- the merge


def _sort_index(code: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative codes."""
    n = len(code)
    key = code.astype(np.uint64) << np.uint64(32) | np.arange(n, dtype=np.uint64)
    key.sort()
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _dense(x: np.ndarray, y: np.ndarray | None = None) -> np.ndarray:
    """Ranks from 0 of 64-bit hashes, or of pairs of small codes."""
    n = len(x)
    bits = max(1, n.bit_length())
    if y is None:  # sorted by the upper bits, which all but always tell hashes apart, with the place in the lower ones
        key = x.view(np.uint64) >> np.uint64(bits) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    else:
        wide = int(y.max(initial=0)).bit_length()
        if int(x.max(initial=0)).bit_length() + wide + bits > 64:
            return np.unique(x.astype(np.uint64) << np.uint64(32) | y.astype(np.uint64), return_inverse=True)[1]
        x = x.astype(np.uint64) << np.uint64(wide) | y.astype(np.uint64)
        key = x << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    at = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    value = x[at]
    apart = value[1:] != value[:-1]
    if y is None and (apart & (key[1:] >> np.uint64(bits) == key[:-1] >> np.uint64(bits))).any():
        return np.unique(x, return_inverse=True)[1]
    rank = np.empty(n, np.int64)
    rank[at] = np.concatenate(([0], np.cumsum(apart)))[:n]
    return rank


def transform(symbol: np.ndarray, after: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and Burrows-Wheeler transform of a shard. symbol: 0 ends a chain; after and before: the places that
    follow and precede each place in its chain, or -1."""
    rank, jump = symbol, after
    while True:
        following = np.where(jump >= 0, rank[jump] + 1, 0)
        rank = _dense(rank, following)
        if not (jump >= 0).any():
            break
        jump = np.where(jump >= 0, jump[jump], -1)
    order = _sort_index(rank)
    back = before[order]
    return order, np.where(back >= 0, symbol[back], 0)


def merge(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave (the shard of each merged place) and, for each place, the number of symbols it shares with the place
    before, up to rounds. Symbols are codes that all shards share; 0 ends a chain."""
    z = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    symbols = np.concatenate(transforms)
    group = np.zeros(len(z), np.int64)
    shared = np.full(len(z), rounds, np.int64)
    if len(z):
        shared[0] = 0
    for depth in range(rounds):
        seen = np.empty(len(z), symbols.dtype)
        seen[np.argsort(z, kind="stable")] = symbols  # each shard's transform is read in its own order
        deal = _sort_index(seen)
        z, seen, group = z[deal], seen[deal], group[deal]
        apart = np.zeros(len(z), bool)
        apart[1:] = (seen[1:] != seen[:-1]) | ((group[1:] != group[:-1]) & (seen[1:] != 0))
        shared[apart & (shared > depth)] = depth
        group = np.cumsum(apart)
    return z, shared


def repeated_windows(texts: list[bytes], weights: np.ndarray, width: int, steps: int, shards: int = SHARDS) -> list[np.ndarray]:
    """For each string, the windows (their starts) whose bytes are found twice or more, weights counted."""
    g = width // steps
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    off = np.concatenate(([0], np.cumsum(size)))
    prefix = c.prefix_hash(data)
    # Place p of string i, 0 <= p <= size, is element off[i] + i + p; the last g of them end a chain.
    string = np.repeat(np.arange(len(texts)), size + 1)
    place = np.arange(len(string)) - (off[:-1] + np.arange(len(texts)))[string]
    inner = place + g <= size[string]
    byte = (off[:-1][string] + place)[inner]
    symbol = np.zeros(len(string), np.int64)
    symbol[inner] = _dense(c.span_hash(prefix, byte, byte + g)) + 1
    cuts = np.searchsorted(string, np.linspace(0, len(texts), min(shards, len(texts)) + 1).astype(int))
    orders, transforms = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        own = np.arange(hi - lo)
        after = np.where(inner[lo:hi], own + g, -1)
        before = np.where(place[lo:hi] >= g, own - g, -1)
        order, bwt = transform(symbol[lo:hi], after, before)
        orders.append(order + lo)
        transforms.append(bwt)
    z, shared = merge(transforms, steps)
    element = np.empty(len(z), np.int64)
    element[np.argsort(z, kind="stable")] = np.concatenate(orders)
    window = place[element] + width <= size[string[element]]
    interval = np.cumsum(shared < steps)
    total = np.bincount(interval, np.where(window, weights[string[element]], 0))
    found = np.sort(element[window & (total[interval] > 1)])
    at = np.searchsorted(string[found], np.arange(len(texts) + 1))
    return [place[found[a:b]] for a, b in zip(at[:-1], at[1:], strict=True)]


def _ranges(windows: np.ndarray) -> list[int]:
    """Runs of windows as first << 16 | last."""
    if not len(windows):
        return []
    gap = np.flatnonzero(np.diff(windows) > 1)
    return (windows[np.append(0, gap + 1)] << 16 | windows[np.append(gap, len(windows) - 1)]).tolist()


def _merge_blocks(strings: DataFrame, width: int, steps: int) -> DataFrame:
    """s, runs: the runs of repeated windows in each string of (s, key, m, text), strings of one key compared."""

    def block(rows):
        found = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows]), width, steps)
        keep = [(r[0], _ranges(w)) for r, w in zip(rows, found, strict=True) if len(w)]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keep], pa.int64()), pa.array([v for _, v in keep], pa.list_(pa.int32()))], ["s", "runs"])

    @c.lean
    def run(batches):
        rows, size = [], 0
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if size > BLOCK_BYTES and r[1] != rows[-1][1]:
                    yield block(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3])
        if rows:
            yield block(rows)

    dealt = strings.select("s", "key", "m", "text").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "s long, runs array<int>")


def _split(strings: DataFrame, width: int, run_of: int) -> DataFrame:
    """Finer strings: at most run_of windows each, keyed by the bytes that all these windows share and their place.

    The place is that of the windows in the span, counted from the anchor's window offset `o`, so that equal windows get
    equal keys. Columns: s (the coarser string), base (its first window in that string), key, s2 (name), m, text."""

    kinds = {"s": pa.int64(), "base": pa.int32(), "key": pa.int64(), "s2": pa.int64(), "o": pa.int32(), "m": pa.int64(), "text": pa.binary()}

    def finer(b: pa.RecordBatch) -> Iterator[tuple]:
        for s, key, o, m, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            n, w = len(text) - width + 1, 0
            while w < n:
                # o - w: how far window w starts before the anchor
                take = min(n - w, (o - w) % run_of + 1)
                slot = (o - w) // run_of
                common = text[o - slot * run_of : o - slot * run_of - (run_of - 1) + width]
                piece = text[w : w + take + width - 1]
                name = hashlib.blake2b(common, digest_size=8, salt=(key & (1 << 64) - 1).to_bytes(8, "little") + slot.to_bytes(4, "little")).digest()
                name2 = hashlib.blake2b(piece, digest_size=8, salt=name, person=((o - w) << 16 | take).to_bytes(4, "little")).digest()
                yield s, w, int.from_bytes(name, "little", signed=True), int.from_bytes(name2, "little", signed=True), o - w, m, piece
                w += take

    @c.lean
    def run(batches):
        for b in batches:
            yield from batches_of(finer(b), kinds)

    return strings.select("s", "key", "o", "m", "text").mapInArrow(run, "s long, base int, key long, s2 long, o int, m long, text binary")


def resolve(own: c.Scratch, strings: DataFrame, width: int, steps: int, hot: int, run_of: int = CHUNK) -> DataFrame:
    """s, runs for distinct strings (s, key, o, m, text); keys with more than `hot` strings are dealt by finer ones. Single
    windows end it: equal ones are then one string, so a key has one."""
    crowded = own.cut(strings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"))
    if not crowded.take(1):
        return _merge_blocks(strings, width, steps)
    out = _merge_blocks(strings.join(crowded, "key", "left_anti"), width, steps)
    pieces = own.cut(_split(strings.join(crowded, "key", "left_semi"), width, run_of))
    each = pieces.groupBy(F.col("s2").alias("s"), "key").agg(F.sum("m").alias("m"), F.max(F.struct("o", "text")).alias("x"))
    each = own.cut(each.select("s", "key", "x.o", "m", "x.text"))
    if run_of > 1:
        found = resolve(own, each, width, steps, hot, 1)
    else:
        found = _merge_blocks(each, width, steps)
    moved = F.transform("runs", lambda r: r + (F.col("base") * 65537).cast("int"))
    finer = pieces.select(F.col("s").alias("whole"), "base", F.col("s2").alias("s")).join(found, "s")
    return out.unionByName(finer.select(F.col("whole").alias("s"), moved.alias("runs")))


def repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, steps: int = STEPS, hot: int = HOT_STRINGS) -> DataFrame:
    """doc_id, t, cuts: packed start << 32 | end of byte ranges that cover what is to be removed, for the texts that have any."""
    own = c.Scratch(docs.sparkSession)
    # a table of its own, so that the join below is one of two shuffled sides, whose hot anchors Spark splits
    again = own.cut(anchors(docs, width, gram, False).groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"))
    places = own.cut(anchors(docs, width, gram, True).join(again, "a"))
    own.drop(again)
    each = places.groupBy("s", "a").agg(F.count("*").alias("m"), F.min(F.struct("doc_id", "t", "at")).alias("x"))
    strings = own.cut(span_texts(c.one_each(own, docs), each.select("s", "a", "m", "x.doc_id", "x.t", "x.at"), width))
    runs = own.cut(resolve(own, strings, width, steps, hot))
    own.drop(strings)
    first = F.shiftright("at", 32)
    ends = F.transform(
        "runs",
        lambda r: F.shiftleft(first + F.shiftright(r, 16), 32).bitwiseOR(first + r.bitwiseAND(F.lit(0xFFFF)) + width),
    )
    per_text = places.select("doc_id", "t", "at", "s").join(runs, "s").select("doc_id", "t", F.explode(ends).alias("cut"))
    out = c.cut(per_text.groupBy("doc_id", "t").agg(F.collect_set("cut").alias("cuts")))
    own.clear()
    return out


def _united(cuts: list[int], size: int) -> list[tuple[int, int]]:
    """The ranges of cuts, sorted and united, within a text of that size."""
    out: list[tuple[int, int]] = []
    for x in sorted(cuts):
        lo, hi = x >> 32, min(x & 0xFFFFFFFF, size)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        elif lo < hi:
            out.append((lo, hi))
    return out


def _kept(text: bytes, cuts: list[int] | None) -> tuple[list[tuple[int, int]], bytes]:
    spans = _united(cuts or [], len(text))
    edges = [0, *(x for r in spans for x in r), len(text)]
    return spans, b"".join(text[lo:hi] for lo, hi in zip(edges[::2], edges[1::2], strict=True))


def removal_report(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs."""

    @c.lean
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            out = [[] for _ in range(4)]
            for packed, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                text = z.decompress(packed)
                spans, kept = _kept(text, found)
                for col, v in zip(out, (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()), strict=True):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    joined = c.packed_texts(docs).join(cuts.toDF("d", "d_t", "cuts"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("d_t")), "left")
    return joined.select("doc_id", "z", "cuts").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """docs without the repeated bytes; a character that a cut tears goes with it, and a document that loses all its text
    is dropped. All columns are kept; n_chars, if there, is that of a changed text."""
    name, at, key = c.fresh("cuts", docs), c.fresh("at", docs), c.fresh("text_key", docs)
    cuts = repeats(docs, **options).toDF(at, key, name)

    @F.arrow_udf("string")
    @c.lean
    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, found in batches:
            out = []  # row by row: a batch of texts and cuts as Python objects would be many times its size
            for t, f in zip(text, found, strict=True):
                out.append(None if not t.is_valid else _kept(t.as_py().encode(), f.as_py())[1].decode("utf-8", "ignore"))
            yield pa.array(out, pa.string())

    kept = kept.asNondeterministic()  # so that the filter on its result does not run it a second time
    joined = docs.join(cuts, docs["doc_id"].cast("long").eqNullSafe(F.col(at)) & (c.text_hash() == F.col(key)), "left")
    whole = F.col("text").cast("string")
    changed = F.col(name).isNotNull()
    values = {"text": F.when(changed, kept(F.when(changed, whole), name)).otherwise(whole)}
    out = joined.withColumns(values)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.where(~changed | (F.length("text") > 0)).drop(name, at, key)


def remove_repeats(docs: DataFrame, **options: int) -> DataFrame:
    return removal_report(docs, repeats(docs, **options))
