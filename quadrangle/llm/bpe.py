"""BPE encoding and decoding with reuse of content-defined chunks.

1. A rolling hash of the last `ROLL` bytes cuts every text where its low bits are zero, so equal passages are cut alike
   wherever they stand. Chunk hashes are counted over all documents (combined before the shuffle); those found twice or
   more are shared.
2. One document of those that hold a shared chunk encodes it, once; the ids are written to the shared folder.
3. Documents with shared chunks get those ids by a join and encode only the gaps between them. The rest of the documents,
   told apart by a bitmap of fixed size, never meet a shuffle.
4. Chunk joins are repaired: the text from the second seam before a cut to the second seam after it is encoded again; it
   must agree with the tokens there up to the first seam on either side, else the window grows, up to the whole text. A
   seam is a space between two characters that are surely none, where the tokenizer's pattern always starts a new piece.
   The bytes of the result must be those of the text, which also rules out a hash collision; else the text is encoded
   whole.

What is encoded is first cut at its seams, and a worker encodes equal units between seams once.

Defined cases: null text is empty and has no ids. Special tokens that stand in a text are recognised, as the library does.
Repeated rows and null doc_ids are rows like any other. A null list of ids decodes to the empty text. Other columns of
`documents` are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c
from quadrangle.llm.units import Units, as_shown, byte_characters, in_order, last_signs, latin_word, tokenizer

#: Bytes that the rolling hash sees, mean bytes of a chunk, and bytes under which a chunk is not shared.
ROLL, MEAN, LEAST = 48, 512, 64
#: Units that a worker remembers.
UNITS = 1 << 18
#: The bitmap that tells documents with shared chunks from others: words of 64 bits.
BITMAP_WORDS = 1 << 17


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    back = byte_characters()
    vocab = tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for word, i in vocab.items():
        out[i] = bytes(back[x] for x in word) if all(x in back for x in word) else word.encode()
    return out


@functools.cache
def token_sizes(path: str) -> np.ndarray:
    return np.array([len(b) for b in token_bytes(path)], np.int64)


def seams(data: np.ndarray, breaks: bytes = b" ") -> np.ndarray:
    """Places of a space (or another of breaks) between two characters that are no white space for certain: graphic ASCII or
    U+00C0 to U+00FF. The pattern's pieces always start there, and the same ones whatever stands further on."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(np.isin(data[1:-1], np.frombuffer(breaks, np.uint8))) + 1
    before, after = data[at - 1], data[at + 1]
    wide = (before >= 0x80) & (before < 0xC0) & (data[np.maximum(at - 2, 0)] == 0xC3) & (at > 1)
    return at[(((before > 0x20) & (before < 0x7F)) | wide) & (((after > 0x20) & (after < 0x7F)) | (after == 0xC3))]


def _word(unit: str) -> str | None:
    """A word of Latin letters with the space before it is one piece."""
    letters = unit[1:] if unit[0] == " " else unit
    return as_shown(unit) if latin_word(letters) else None


@functools.cache
def worker_units(path: str) -> Units:
    """One memory for all tasks of a worker process."""
    return Units(path, _word, [], UNITS)


def encode_bytes(units: Units, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts (UTF-8), one after another, and how many each has. Texts are cut at their seams, line feeds
    included, and the units between them are encoded once for the worker."""
    n, rows = len(data), len(offsets) - 1
    cuts = seams(data, b" \n")
    start = np.unique(np.concatenate((offsets[:-1], cuts, cuts[data[cuts] == 0x0A] + 1)))
    start = start[start < n]
    row = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(np.append(start[1:], n), offsets[row + 1])
    sign = last_signs(data, start, end)
    end = end - (sign > 0)

    def text_of(at: np.ndarray) -> list[str]:
        raw = data.tobytes()
        return [raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]

    code = units.codes(c.word_hash(data, start, end), text_of)
    unit, per_row = in_order(code, sign, row, rows, False)
    flat, ends = units.gather(unit)
    edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(per_row)))]
    return flat, np.diff(edges)


def encode_all(texts: list[str] | list[bytes], path: str) -> list[np.ndarray]:
    """The ids of each text."""
    out: list[np.ndarray] = []
    for _, _, data, off in c.steps(pa.array(texts, pa.large_binary() if texts and isinstance(texts[0], bytes) else pa.large_string())):
        flat, n = encode_bytes(worker_units(path), data, off)
        out += np.split(flat, np.cumsum(n)[:-1])
    return out


def _texts(flat: np.ndarray, counts: np.ndarray, path: str) -> pa.Array:
    """The texts that runs of ids stand for."""
    table, at = token_bytes(path), np.concatenate(([0], np.cumsum(counts)))
    whole = (b"".join([table[i] for i in flat[a:b].tolist()]) for a, b in zip(at[:-1], at[1:], strict=True))
    return pa.array([w.decode("utf-8", "replace") for w in whole], pa.string())


def _batch(doc_ids: pa.Array, flat: np.ndarray, counts: np.ndarray, path: str, text: str | None) -> pa.RecordBatch:
    columns = [doc_ids, c.list_array(pa.array(flat), counts), *([_texts(flat, counts, path)] if text else [])]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", *([text] if text else [])])


def _schema(text: str | None) -> str:
    return "doc_id long, ids array<int>" + (f", `{text}` string" if text else "")


def cut_places(data: np.ndarray, offsets: np.ndarray, mean: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, row numbers of the chunks of all rows, and the prefix hash."""
    prefix = c.prefix_hash(data)
    n = len(data)
    at = np.zeros(0, np.int64)
    if n > ROLL:
        roll = c.mix((prefix[ROLL:n] - prefix[: n - ROLL]) * c.powers(n + 1)[1][: n - ROLL])
        at = np.flatnonzero(((roll & np.uint64(mean - 1)) == 0) & ((data[ROLL:] & 0xC0) != 0x80)) + ROLL
        at = at[at - offsets[np.searchsorted(offsets, at, "right") - 1] >= ROLL]
    start = np.unique(np.concatenate((offsets[:-1], at)))
    start = start[start < n]
    row = np.searchsorted(offsets, start, "right") - 1
    end = np.append(start[1:], n)
    return start, np.minimum(end, offsets[row + 1]), row, prefix


def chunks(docs: DataFrame, mean: int) -> DataFrame:
    """One row for each chunk of (doc_id, k, text): h, x (a hash of its place), doc_id, k, at (start << 32 | bytes)."""

    def run(batches):
        for b in batches:
            key = b.column(1).to_numpy().view(np.uint64)
            for lo, _, data, off in c.steps(b.column(2)):
                start, end, row, prefix = cut_places(data, off, mean)
                some = np.flatnonzero(end - start >= LEAST)
                start, end, row = start[some], end[some], row[some]
                local = start - off[row]
                place = c.mix(key[lo + row] + local.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c.signed(c.span_hash(prefix, start, end))),
                        pa.array(c.signed(place)),
                        b.column(0).take(pa.array(lo + row)),
                        b.column(1).take(pa.array(lo + row)),
                        pa.array(local << 32 | (end - start)),
                    ],
                    ["h", "x", "doc_id", "k", "at"],
                )

    return docs.mapInArrow(run, "h long, x long, doc_id long, k long, at long")


def with_key(docs: DataFrame) -> DataFrame:
    """doc_id, k, text: k is a hash of the text, so that rows of one doc_id are told apart unless they are the same."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("k"), text.alias("text"))


def bitmap(rows: DataFrame) -> DataFrame:
    """word, bits for the keys of rows: at most BITMAP_WORDS rows, whatever the input."""
    return rows.select(F.pmod(F.shiftright("k", 6), F.lit(BITMAP_WORDS)).alias("word"), F.expr("shiftleft(1L, cast(k & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def marked(rows: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Rows whose key is in the bitmap (left_semi) or not (left_anti)."""
    hit = (F.pmod(F.shiftright("k", 6), F.lit(BITMAP_WORDS)) == F.col("word")) & F.expr("bits & shiftleft(1L, cast(k & 63 as int)) <> 0")
    return rows.join(F.broadcast(marks), hit, how)


def _with_lists(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """rows (doc_id, k, text) with `items` of (d, k2, items)."""
    return rows.join(lists, (F.col("k") == F.col("k2")) & F.col("doc_id").eqNullSafe(F.col("d")), how)


def encode_shared(docs: DataFrame, owned: DataFrame, path: str) -> DataFrame:
    """h, ids (little-endian 32-bit) of the chunks in owned, each encoded once."""

    def run(batches):
        for b in batches:
            names, texts = [], []
            for text, items in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                for x in items:
                    lo, size = x["at"] >> 32, x["at"] & 0xFFFFFFFF
                    names.append(x["h"])
                    texts.append(text[lo : lo + size])
            ids = [e.tobytes() for e in encode_all(texts, path)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(ids, pa.binary())], ["h", "ids"])

    lists = owned.groupBy(F.col("doc_id").alias("d"), F.col("k").alias("k2")).agg(F.collect_set(F.struct("at", "h")).alias("items"))
    return _with_lists(docs, lists, "inner").select("text", "items").mapInArrow(run, "h long, ids binary").dropDuplicates(["h"])


class _Doc:
    """A text put together from known pieces and gaps; joins() are the windows still to be encoded again."""

    def __init__(self, text: bytes, pieces: dict[int, bytes]):
        self.text, self.pieces, self.gaps, self.parts = text, pieces, [], []
        at = 0
        for start, size in sorted((p >> 32, p & 0xFFFFFFFF) for p in pieces):
            if start < at:
                continue
            if start > at:
                self.gaps.append((at, start))
            self.parts.append((start, pieces[start << 32 | size]))
            at = start + size
        if at < len(text):
            self.gaps.append((at, len(text)))
        self.known = {s: np.frombuffer(b, np.int32) for s, b in self.parts}

    def fill(self, gap_ids: list[np.ndarray], sizes: np.ndarray) -> None:
        segments = self.known | {s: i for (s, _), i in zip(self.gaps, gap_ids, strict=True)}
        starts = sorted(segments)
        self.ids = np.concatenate([segments[s] for s in starts]) if starts else np.zeros(0, np.int32)
        self.ends = np.cumsum(sizes[self.ids])
        data = np.frombuffer(self.text, np.uint8)
        self.seams = np.concatenate(([0], seams(data), [len(data)]))
        self.sizes = sizes
        self.windows = self._merged([self._window(x, x, 2) for x in starts[1:]])

    def _window(self, first: int, last: int, reach: int) -> tuple[int, int, int, int, int, int, int]:
        """From and to; the inner seams up to which it must agree; the cuts in it; and how many seams it reaches over."""
        left = int(np.searchsorted(self.seams, first, "right")) - 1
        right = int(np.searchsorted(self.seams, last, "left"))
        s, n = self.seams, len(self.seams) - 1
        return int(s[max(0, left - reach + 1)]), int(s[min(n, right + reach - 1)]), int(s[left]), int(s[right]), first, last, reach

    def _merged(self, windows: list) -> list:
        out: list = []
        for w in windows:
            if out and w[0] < out[-1][1]:
                out[-1] = self._window(out[-1][4], w[5], max(out[-1][6], w[6]))
                while len(out) > 1 and out[-1][0] < out[-2][1]:
                    w = out.pop()
                    out[-1] = self._window(out[-1][4], w[5], max(out[-1][6], w[6]))
            else:
                out.append(w)
        return out

    def _index(self, at: int) -> int:
        """Number of tokens before a byte, or -1 if no token starts there."""
        if at == 0:
            return 0
        i = int(np.searchsorted(self.ends, at))
        return i + 1 if i < len(self.ends) and self.ends[i] == at else -1

    def repair(self, encoded: list[np.ndarray]) -> None:
        """Puts the windows' new ids in where they agree; the others stay to be tried again with a wider one."""
        again, swaps = [], []
        for w, ids in zip(self.windows, encoded, strict=True):
            lo, hi, first, last, a, b, reach = w
            i, j, p, q = (self._index(x) for x in (lo, hi, first, last))
            whole = lo == 0 and hi == len(self.text)
            fits = min(i, j, p, q) >= 0
            if fits and not whole:
                head, tail = self.ids[i:p], self.ids[q:j]
                fits = np.array_equal(ids[: len(head)], head) and len(ids) >= len(tail) and np.array_equal(ids[len(ids) - len(tail) :], tail)
            if whole:
                self.ids, again, swaps = ids, [], []
                break
            if fits:
                swaps.append((i, j, ids))
            else:
                again.append(self._window(a, b, reach * 2))
        for i, j, ids in reversed(swaps):
            self.ids = np.concatenate((self.ids[:i], ids, self.ids[j:]))
        self.ends = np.cumsum(self.sizes[self.ids])
        self.windows = self._merged(again)


def assemble(texts: list[bytes], pieces: list[dict[int, bytes]], path: str) -> list[np.ndarray]:
    """The ids of each text, given the ids of some of its chunks by their place."""
    docs = [_Doc(t, p) for t, p in zip(texts, pieces, strict=True)]
    sizes = token_sizes(path)
    gaps = iter(encode_all([d.text[a:b] for d in docs for a, b in d.gaps], path))
    for d in docs:
        d.fill([next(gaps) for _ in d.gaps], sizes)
    while todo := [d for d in docs if d.windows]:
        new = iter(encode_all([d.text[w[0] : w[1]] for d in todo for w in d.windows], path))
        for d in todo:
            d.repair([next(new) for _ in d.windows])
    table = token_bytes(path)
    wrong = [d for d in docs if b"".join([table[i] for i in d.ids.tolist()]) != d.text]
    for d, ids in zip(wrong, encode_all([d.text for d in wrong], path), strict=True):
        d.ids = ids
    return [d.ids for d in docs]


def _encode_alone(docs: DataFrame, path: str, text: str | None) -> DataFrame:
    def run(batches):
        for b in batches:
            for lo, hi, data, off in c.steps(b.column(1)):
                flat, n = encode_bytes(worker_units(path), data, off)
                yield _batch(b.column(0).slice(lo, hi - lo), flat, n, path, text)

    return docs.select("doc_id", "text").mapInArrow(run, _schema(text))


def _encode_joined(rows: DataFrame, path: str, text: str | None) -> DataFrame:
    def run(batches):
        for b in batches:
            for lo, hi, _, _ in c.steps(b.column(1)):
                part = b.slice(lo, hi - lo)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                pieces = [{x["at"]: x["ids"] for x in items or ()} for items in part.column(2).to_pylist()]
                ids = assemble(texts, pieces, path)
                yield _batch(part.column(0), np.concatenate(ids), np.array([len(x) for x in ids], np.int64), path, text)

    return rows.select("doc_id", "text", "items").mapInArrow(run, _schema(text))


def encode(docs: DataFrame, path: str | None = None, mean: int = MEAN, decoded: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) for every row of docs. mean: bytes of a chunk on average, a power of two. decoded: name of a
    column with the texts that the ids decode to, made by the same tasks."""
    path = path or vocabulary()
    rows = with_key(docs)
    shared = chunks(rows, mean).groupBy("h").agg(F.count("*").alias("n"), F.min("x").alias("owner")).where("n > 1").select("h", "owner")
    places = c.cut(chunks(rows, mean).join(shared, "h").select("h", "doc_id", "k", "at", (F.col("x") == F.col("owner")).alias("owns")))
    owned = places.where("owns").select("h", "doc_id", "k", "at").distinct()
    known = c.cut(encode_shared(marked(rows, c.cut(bitmap(owned)), "left_semi"), owned, path))
    marks = c.cut(bitmap(places))
    lists = places.join(known, "h").groupBy(F.col("doc_id").alias("d"), F.col("k").alias("k2")).agg(F.collect_list(F.struct("at", "ids")).alias("items"))
    joined = _encode_joined(_with_lists(marked(rows, marks, "left_semi"), lists, "left"), path, decoded)
    return _encode_alone(marked(rows, marks, "left_anti"), path, decoded).unionByName(joined)


def decode(encoded: DataFrame, path: str | None = None, name: str = "decoded") -> DataFrame:
    """encoded with a column of the texts that its `ids` stand for, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    path = path or vocabulary()

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        counts = np.nan_to_num(pc.list_value_length(ids).to_numpy(zero_copy_only=False)).astype(np.int64)
        return _texts(ids.flatten().to_numpy(zero_copy_only=False), counts, path)

    return encoded.withColumn(name, text("ids"))
