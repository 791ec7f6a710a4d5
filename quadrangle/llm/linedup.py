"""Line dedup by a segment-partition edit join.

A line is a sequence of tokens: words, or single characters of scripts without spaces. Two lines are linked when at most
`limit(n)` tokens must be changed, n being the tokens of the longer one: none below 4, one below 16, two below 48, then n / 16;
lines below 8 tokens must also be within two characters of each other. A line is cut into limit + 1 segments; by the pigeonhole
principle a linked line has one of them unchanged.

* Up to two edits a line is indexed under its segments, with their number and its length, and probes, for each length in reach,
  the substrings that can meet a segment there (multi-match-aware selection).
* Beyond, probes would grow with the cube of the limit. There a segment has at least SEGMENT tokens, so it holds one of the
  grams that have the smallest hash in a window of SEGMENT tokens; a line is indexed under all its grams of that kind, which
  are those of every segment wherever a linked line may have it.
* What meets must pass a parity signature of its tokens, of which an edit changes two bits at most: a narrow one beside the key, and
  before texts are moved a wide one, in which equal tokens of a line are told apart by their number, and which grows with lines of LONG
  tokens and more, where it is of pairs of tokens: an edit changes four of its bits at most. Then it is verified by a banded
  bit-parallel edit distance, of many pairs at once; a few pairs of up to NEAR edits are followed along diagonals. No filter loses a link.

A key goes to its task once, with the line's number of tokens and a signature, so a task tells from keys alone which lines of its
groups can be linked; lines of a group are in order of their tokens' number, and meet as far as their limits reach. Their pairs are
verified by a join with the lines' texts. A group with many such pairs for its size, as near copies make, is not written as pairs: its
lines meet in one task with a wider signature, where a pair that earlier links already connect is not looked at. Near copies share
nearly all their keys, so groups of one leader (the line with the most neighbours) are put together wherever that makes fewer pairs, and a
line's text goes there once; groups beyond BLOCK lines or BLOCK_TOKENS are divided into blocks, and each pair of blocks is a task.
A key of more than `rounds.CROWDED` lines is divided by a band of the lines' number of tokens. If more than LARGE times as many lines are
left with a key, it gets one more part: at the far end of the line's longer side, before or behind what is shared, one of the
outermost limit + 1 segments of SMALL tokens must be unchanged too. Where the sides are too short for that, one of 2 * limit + 1 parts of
the lines' parity bits is that part: linked lines have one of them alike.

Exact copies are one text however many they are; copies of any length are found.

Defined cases: lines are split at \\n; a line without a character other than white space (0x20, 0x09 to 0x0D) has no row; null text
has no lines. Ties go to the smallest (doc_id, line_no, text hash). A null doc_id sorts first. Rows of a doc_id, or without one,
are told apart by a hash of their text. Rows alike in doc_id and text have lines of one place: each such row is `kept` if the
first of them is. Other columns are passed through by `dedup_lines` and ignored by `line_classes`.
"""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quadrangle.llm import common as c
from quadrangle.llm import rounds

#: Tokens from which 1, 2 and more edits are allowed (then one for each STEP tokens), and below which characters count too.
ONE, TWO, STEP, FEW, FEW_CHARS = 4, 16, 16, 8, 2
#: Tokens from which keys are grams of windows, tokens of such a window (the fewest of a segment there), and of a gram.
MANY, SEGMENT, GRAM = 48, 12, 5
#: Tokens of a gram that is the second part of a key.
SMALL = 3
#: Bytes of text that are worked on at once, with about a dozen numbers for each.
STEP_BYTES = 1 << 20
#: Parity bits of a line's tokens, beside a key and within a group that is linked in a task.
KEY_BITS, BITS = 48, 1024
#: Tokens from which BITS are too few for what the limit allows, and a line also has parities of its pairs of tokens, a bit for each token at least.
LONG = 2048
#: Edits up to which many pairs are verified at once, as a band must fit a 64-bit number; tokens of the longest pair, for each, that are then worked on.
BAND, BAND_TOKENS = 31, 1 << 19
#: Pairs of a group that are verified before its next lines are compared, and 64-bit numbers of a line's parities that are compared first.
AT_ONCE, SOME = 384, 4
#: Bits beside those for the number of tokens; lines of this number or more are told apart by their texts alone.
SIZE_BITS = 16
#: Edits up to which diagonals are followed, as that takes the square of them; pairs fewer than which are verified one by one, or in a wider band.
NEAR, ALONE, TOGETHER = 7, 8, 256
#: Pairs for each line of a group that are written as pairs, and lines and tokens of a group that meet in one task.
DENSE, BLOCK, BLOCK_TOKENS = 8, 2048, 1 << 18
#: A band of numbers of tokens ends at so many times its beginning; times `rounds.CROWDED` lines of a key and a band that meet in one task.
BAND_WIDTH, LARGE = 1.25, 8
NEWLINE = 10
#: White space: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
# Code points of scripts that are written without spaces, from and to.
UNSPACED = ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xA4D0), (0xF900, 0xFB00), (0xFE30, 0xFE50), (0xFF00, 0xFFF0), (0x1F000, 0x40000))


def edit_distance(a: str | list[str], b: str | list[str], k: int) -> int:
    """Edit distance of two strings or lists of tokens, or k + 1 if it is larger. Columns are a band of 2k + 1 diagonal bits."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > k:
        return k + 1
    lo, end = 0, len(b)
    while lo < end and a[lo] == b[lo]:
        lo += 1
    while end > lo and a[end - 1 + len(a) - len(b)] == b[end - 1]:
        end -= 1
    a, b = a[lo : end + len(a) - len(b)], b[lo:end]
    m, n = len(a), len(b)
    if not n or not k:
        return min(max(m, n), k + 1)
    width = 2 * k + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << (i + k)  # k bits of room above row 1
    # Bit r of column j stands for row j - k + r of a; vp and vn say where the value rises or falls from the row above.
    vp, vn, score = (full >> k) << k, 0, k
    for j in range(1, n + 1):
        match = where.get(b[j - 1], 0) >> (j - 1) & full
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        d0 &= full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if not d0 >> (width - 1) & 1:  # down the lowest diagonal
            score += 1
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
    # score is that of row n + k; walk up to row m.
    for r in range(n + k, m, -1):
        bit = r - (n + k) + width - 2
        score -= (vp >> bit & 1) - (vn >> bit & 1)
    return min(score, k + 1)


def limit(n: int) -> int:
    """Token edits allowed between two lines, the longer one of n tokens."""
    return 0 if n < ONE else 1 if n < TWO else 2 if n < MANY else n // STEP


_BLANKS, _ODD = dict.fromkeys(range(0x09, 0x0E), " "), re.compile("[\t-\r]")


def tokens(line: str) -> list[str]:
    """The tokens of a line; the vectorised form below agrees with it."""
    words = [w for w in (line.translate(_BLANKS) if _ODD.search(line) else line).split(" ") if w]
    if line.isascii() or max(line) < chr(UNSPACED[0][0]):
        return words
    out: list[str] = []
    for word in words:
        run = ""
        for ch in word:
            if any(lo <= ord(ch) < hi for lo, hi in UNSPACED):
                out += [run, ch] if run else [ch]
                run = ""
            else:
                run += ch
        if run:
            out.append(run)
    return out


def within(a: np.ndarray, b: np.ndarray, k: int) -> bool:
    """Whether at most k edits lead from a to b: the furthest place on each diagonal, for one edit more at a time."""
    m, goal = len(a), len(b) - len(a)
    stops: dict[int, list[int]] = {}

    def run(i: int, d: int) -> int:  # the first place from i on where a and b, moved by d, differ or end
        if d not in stops:
            lo, hi = max(0, -d), min(m, len(b) - d)
            stops[d] = [*(np.flatnonzero(a[lo:hi] != b[lo + d : hi + d]) + lo).tolist(), hi]
        return stops[d][bisect_left(stops[d], i)]

    if abs(goal) > k:
        return False
    reach = {0: run(0, 0)}
    for edits in range(1, k + 1):
        if reach.get(goal) == m:
            return True
        last, reach = reach, {}
        for d in range(max(-edits, goal - k + edits, -m), min(edits, goal + k - edits, len(b)) + 1):
            i = max(last.get(d, -2) + 1, last.get(d - 1, -1), last.get(d + 1, -2) + 1)
            if i >= 0:
                reach[d] = run(min(i, m, len(b) - d), d)
    return reach.get(goal) == m


def limits(n: np.ndarray) -> np.ndarray:
    """limit() of each."""
    return np.where(n < ONE, 0, np.where(n < TWO, 1, np.where(n < MANY, 2, n // STEP)))


def _rows(values: np.ndarray, start: np.ndarray, n: np.ndarray, width: int, at: int) -> np.ndarray:
    """Runs of values as rows that begin at column `at`; 0 elsewhere."""
    out = np.zeros((len(n), width), np.uint64)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out.reshape(-1)[np.repeat(np.arange(len(n)) * width + at, n) + step] = values[np.repeat(start, n) + step]
    return out


def _band_distances(values: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """edit_distance() of runs of m values from a on and of n, no more than m and at least m - k, from b on, in falling order of n: exact up to k."""
    width = 2 * k + 1
    kind = next(x for x in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(x).bits > width)
    bits, full, one = np.iinfo(kind).bits, kind((1 << width) - 1), kind(1)
    x, y = _rows(values, a, m, int(n[0]) + bits, k), _rows(values, b, n, int(n[0]), 0)
    vp, vn, score = np.full(len(n), (int(full) >> k) << k, kind), np.zeros(len(n), kind), np.full(len(n), k)
    going = np.searchsorted(-n, -np.arange(int(n[0])), "left").tolist()  # runs that are longer than j
    for j, some in enumerate(going):
        match = np.packbits(x[:some, j : j + bits] == y[:some, j : j + 1], axis=1, bitorder="little").view(kind)[:, 0] & full
        p, q = vp[:some], vn[:some]
        d0 = ((((match & p) + p) ^ p) | match | q) & full
        hp, hn, down = (q | ~(d0 | p)) & full, d0 & p, d0 >> one
        score[:some] += ((d0 >> kind(width - 1)) ^ one).astype(np.int64)
        vp[:some], vn[:some] = (hn | ~(down | hp)) & full, down & hp
    above = (n + k - m).astype(np.uint64)  # rows from that of score up to row m
    rows = ((np.uint64(1) << above) - np.uint64(1)) << (np.uint64(width - 1) - above)
    return score - np.bitwise_count(vp & rows) + np.bitwise_count(vn & rows)


def few_edits(values: np.ndarray, start: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether limit() edits lead from one line to the other, for pairs of lines given by their first token hash and number of tokens."""
    longer = n[left] >= n[right]
    a, b = np.where(longer, left, right), np.where(longer, right, left)
    k = limits(n[a])
    out = np.zeros(len(a), bool)
    todo = n[a] - n[b] <= k
    for most in (3, 7, 15, BAND):
        at = np.flatnonzero(todo & (k <= most))
        if len(at) < (ALONE if most == BAND else TOGETHER):
            continue  # a few pairs go with those of a wider band
        todo[at] = False
        at = at[np.argsort(-n[b[at]], kind="stable")]
        while len(at):
            some = at[: max(1, BAND_TOKENS // int(n[b[at[0]]] + 2 * most + 2))]
            at = at[len(some) :]
            out[some] = _band_distances(values, start[a[some]], n[a[some]], start[b[some]], n[b[some]], most) <= k[some]
    for i in np.flatnonzero(todo).tolist():
        x, y = (values[start[t] : start[t] + n[t]] for t in (a[i], b[i]))
        most = int(k[i])
        out[i] = within(x, y, most) if most <= NEAR else edit_distance(x.tolist(), y.tolist(), most) <= most
    return out


def linked(lines: pa.Array, values: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of the lines, given with their token hashes (see _tokens_of), are linked."""
    out = few_edits(values, np.cumsum(n) - n, n, left, right)
    for i in np.flatnonzero(out & (np.maximum(n[left], n[right]) < FEW)).tolist():
        out[i] = edit_distance(lines[left[i]].as_py(), lines[right[i]].as_py(), FEW_CHARS) <= FEW_CHARS
    return out


def named_grams(acc: np.ndarray, start: np.ndarray, end: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the grams that spans (in order, of gram + window - 1 characters at least) name, and their number for each."""
    n = len(acc) - gram
    if n <= 0 or not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(start), np.int64)
    g = c.span_hash(acc, np.arange(n), np.arange(n) + gram)
    edge = np.zeros(n + 1, np.int32)  # 1 where a window of grams may begin
    np.add.at(edge, start, 1)
    np.add.at(edge, end - gram - window + 2, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]))
    least = g[at]
    for i in range(1, window):
        least = np.minimum(least, g[at + i])
    named = np.zeros(n, bool)
    for i in range(window):
        named[at[g[at + i] == least] + i] = True
    named = np.flatnonzero(named)
    owner = np.searchsorted(start, named, "right") - 1
    order = np.lexsort((g[named], owner))
    owner, value = owner[order], g[named][order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])) if len(owner) else np.zeros(0, bool)
    return value[new], np.bincount(owner[new], minlength=len(start))


def _offsets(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of the probes, without those that are the line's own index keys."""
    out = []
    for diff in range(edits + 1):
        for seg in range(edits + 1):
            lo = max(-seg, diff - (edits - seg))
            hi = min(seg, diff + edits - seg)
            out += [(diff, seg, s) for s in range(lo, hi + 1) if (diff, s) != (0, 0)]
    return out


def _segment(length: np.ndarray, seg: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of a segment of lines of these lengths: even parts, the longer ones last."""
    size, longer = length // parts, length % parts
    first = parts - longer
    return seg * size + np.maximum(0, seg - first), size + (seg >= first)


def numbered(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Token hashes, of each run in any order, in which the first, second, ... of equal tokens differ. An edit takes away one and adds one."""
    v = values + np.repeat(c.mix(np.arange(1, len(counts) + 1, dtype=np.uint64)), counts)  # equal only within a run
    order = np.argsort(v)
    v = v[order]
    again = np.flatnonzero(np.append(False, v[1:] == v[:-1]))
    if not len(again):
        return values
    place = np.arange(len(v))
    first = np.ones(len(v), bool)
    first[again] = False
    number = again - np.maximum.accumulate(np.where(first, place, 0))[again]
    out = values.copy()
    out[order[again]] = c.mix(values[order[again]] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def parities(values: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """A row of bits for each run of token hashes: whether an odd number of tokens has that bit. An edit changes two at most."""
    at = np.repeat(np.arange(len(counts)), counts) * bits + ((values >> np.uint64(40)) % np.uint64(bits)).astype(np.int64)
    return (np.bincount(at, minlength=len(counts) * bits) & 1).astype(np.uint8).reshape(len(counts), bits)


def pair_parities(values: np.ndarray) -> np.ndarray:
    """Parity bits (64-bit numbers) of a line's pairs of neighbouring tokens, at least as many bits as tokens. An edit changes four at most."""
    bits = 1 << max(6, (len(values) - 1).bit_length())
    both = c.mix(values[:-1] * np.uint64(0x9E3779B97F4A7C15) + values[1:])
    return np.packbits(parities(numbered(both, np.array([len(both)])), np.array([len(both)]), bits), axis=1).view(np.uint64)[0]


def pairs_alike(x: np.ndarray, y: np.ndarray, k: int) -> bool:
    """Whether lines with such pair_parities() can be linked by k edits. Half as many bits are the two halves of them, one upon the other."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) <= 4 * k


def abouts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of tokens (SIZE_BITS) and, above it, parities of each run of token hashes."""
    odd = np.packbits(np.pad(parities(values, counts, KEY_BITS), ((0, 0), (0, 64 - KEY_BITS))), axis=1, bitorder="little").view(np.int64)[:, 0]
    return odd << SIZE_BITS | np.minimum(counts, (1 << SIZE_BITS) - 1)


def possible(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether lines with such abouts() can be linked."""
    most = (1 << SIZE_BITS) - 1
    n, m = x & most, y & most
    longer = np.maximum(n, m)
    k = limits(longer)
    return (longer == most) | (np.abs(n - m) <= k) & (np.bitwise_count((x ^ y).view(np.uint64) >> np.uint64(SIZE_BITS)) <= 2 * k)


def _token_spans(chars: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all tokens; rows: where texts begin, and the end."""
    n = len(chars)
    ink = (chars != 0x20) & ((chars < 0x09) | (chars > 0x0D))
    own = np.zeros(n, bool)
    if n and int(chars.max()) >= UNSPACED[0][0]:
        for lo, hi in UNSPACED:
            own |= (chars >= lo) & (chars < hi)
    cut = np.ones(n + 1, bool)  # a token cannot go on across the place before character i
    cut[1:n] = ~ink[1:] | ~ink[:-1] | own[1:] | own[:-1]
    cut[rows] = True
    return np.flatnonzero(ink & cut[:n]), np.flatnonzero(ink & cut[1:]) + 1


def _lines(data: np.ndarray, off: np.ndarray):
    """Characters; start, end, row and number of each line that is not blank; starts and ends of tokens, and each line's first and end token."""
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    rows = lead[off]
    brk = np.flatnonzero(chars == NEWLINE)
    start = np.sort(np.concatenate((rows[:-1], brk + 1)))
    row = np.searchsorted(rows[:-1], start, "right") - 1
    # a break that ends a row starts no line in the next one: its line is the empty one at the end of its row
    end = np.minimum(np.append(start[1:], len(chars)), rows[row + 1])
    closing = np.zeros(len(chars) + 1, bool)
    closing[brk] = True
    end = end - ((end > start) & closing[np.maximum(end - 1, 0)])
    ts, te = _token_spans(chars, rows)
    first, last = np.searchsorted(ts, start), np.searchsorted(ts, np.maximum(end, start))
    taken = np.flatnonzero(last > first)
    number = np.searchsorted(brk, start[taken]) - np.searchsorted(brk, rows[row[taken]])
    return chars, start[taken], end[taken], row[taken], number, ts, te, first[taken], last[taken]


def _line_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lines' bytes."""
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    raw, name = data.tobytes(), xxhash.xxh3_64_intdigest
    return np.array([name(raw[a:b]) for a, b in zip(at[start].tolist(), at[end].tolist(), strict=True)], np.uint64)


def _token_hashes(chars: np.ndarray, ts: np.ndarray, te: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D)) * c.powers(len(chars) + 1)[0][: len(chars)], out=acc[1:])
    h = c.span_hash(acc, ts, te)
    for i in np.flatnonzero(te - ts > c.EXACT_BYTES).tolist():  # see c.word_hash
        h[i] = xxhash.xxh3_64_intdigest(chars[ts[i] : te[i]].tobytes(), 1)
    return h


def _sequence_hash(values: np.ndarray) -> np.ndarray:
    """A prefix hash of a sequence of 64-bit values, for c.span_hash."""
    acc = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(c.mix(values.copy()) * c.powers(len(values) + 1)[0][: len(values)], out=acc[1:])
    return acc


def line_keys(acc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, and the line that each belongs to, of lines given by their first and end token; and for the keys of segments, which come
    first, their place in the line and size."""
    n = last - first
    keys, lines, places, sizes = [], [], [], []

    def add(which: np.ndarray, length: np.ndarray, parts: int, seg: int, at: np.ndarray, size: np.ndarray) -> None:
        place = first[which] + at
        salt = (length * 8 + parts * 3 + seg).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys.append(c.mix(c.span_hash(acc, place, place + size) + salt))
        lines.append(which)
        places.append(at)
        sizes.append(size)

    for edits, lo, hi in ((1, ONE, TWO - 1), (2, TWO, MANY - 1)):
        parts = edits + 1
        index = np.flatnonzero((n >= lo - edits) & (n <= hi))
        probing = np.flatnonzero((n >= lo) & (n <= hi))
        for seg in range(parts):
            add(index, n[index], parts, seg, *_segment(n[index], seg, parts))
        for diff, seg, shift in _offsets(edits):
            length = n[probing] - diff
            at, size = _segment(length, seg, parts)
            at = at + shift
            fits = (at >= 0) & (at + size <= n[probing]) & (length >= lo - edits)
            add(probing[fits], length[fits], parts, seg, at[fits], size[fits])
    many = np.flatnonzero(n >= MANY - limit(MANY))
    grams, count = named_grams(acc, first[many], last[many], GRAM, SEGMENT - GRAM + 1)
    return np.concatenate([*keys, c.mix(grams)]), np.concatenate([*lines, np.repeat(many, count)]), np.concatenate(places), np.concatenate(sizes)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), c.text_hash().alias("t"), F.col("text").cast("string").alias("text"))


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the whole text), line_no, n_chars, h (hash of the line) of every line that is not blank."""

    @c.lean
    def run(batches):
        for b in batches:
            for lo, _, data, off in c.steps(b.column(2), STEP_BYTES):
                _, start, end, row, number, *_ = _lines(data, off)
                at = pa.array(lo + row)
                columns = [b.column(0).take(at), b.column(1).take(at), pa.array(number.astype(np.int32)), pa.array((end - start).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(c.signed(_line_hashes(data, start, end)))], ["doc_id", "t", "line_no", "n_chars", "h"])

    return _slim(docs).mapInArrow(run, "doc_id long, t long, line_no int, n_chars int, h long")


def key_table(docs: DataFrame) -> DataFrame:
    """key, id (hash of the line), about (see abouts) for the lines of a step of texts that differ."""

    @c.lean
    def run(batches):
        for b in batches:
            for _, _, data, off in c.steps(b.column(0), STEP_BYTES):
                chars, start, end, _, _, ts, te, first, last = _lines(data, off)
                h, one = np.unique(_line_hashes(data, start, end), return_index=True)
                order = np.argsort(one)
                h, one = h[order], one[order]
                values, first, last = _token_hashes(chars, ts, te), first[one], last[one]
                n = last - first
                own = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
                key, line, *_ = line_keys(_sequence_hash(values), first, last)
                columns = [pa.array(c.signed(key)), pa.array(c.signed(h[line])), pa.array(abouts(values[own], n)[line])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "id", "about"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "key long, id long, about long")


def _once(key: np.ndarray, ids: np.ndarray, about: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In order, without repeated rows."""
    order = np.lexsort((ids, key))
    key, ids, about = key[order], ids[order], about[order]
    new = np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])) if len(key) else np.zeros(0, bool)
    return key[new], ids[new], about[new]


def _meeting(key: np.ndarray, ids: np.ndarray, about: np.ndarray, crowded: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs that can be linked, of the members of groups that have too many of them, and of crowded groups; keys in order,
    and the members of each by their number of tokens."""
    most = (1 << SIZE_BITS) - 1
    n = about & most
    least = n - limits(n)  # never falls from a member to the next
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    group, size = np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), len(key)))
    large = size > crowded if crowded else np.zeros(len(size), bool)
    endless = n[np.cumsum(size) - 1] == most  # with a line whose true number is not known
    pairs, full = np.zeros(len(size), np.int64), np.zeros(len(size), bool)
    some, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    alive, step = np.flatnonzero(~large[group]), 0
    while len(alive):
        step += 1
        alive = alive[alive + step < len(key)]
        alive = alive[(group[alive + step] == group[alive]) & ~full[group[alive]] & ((least[alive + step] <= n[alive]) | endless[group[alive]])]
        met = alive[possible(about[alive], about[alive + step])]
        pairs += np.bincount(group[met], minlength=len(size))
        full |= pairs > DENSE * size
        some.append(met)
        other.append(met + step)
    a, b = np.concatenate(some), np.concatenate(other)
    sparse = ~full[group[a]]
    return a[sparse], b[sparse], np.flatnonzero(full[group]), np.flatnonzero(large[group])


def candidates(keys: DataFrame, crowded: int | None) -> DataFrame:
    """From keys (key, id, about): rows (a, b) for pairs of lines that share a key and can be linked; and rows (key, a, about) for the
    lines of groups that have too many such pairs, `crowded` if it is for more than so many lines, which no task holds at once."""

    def rows(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None, about: np.ndarray | None, many: bool) -> pa.RecordBatch:
        columns = [pa.nulls(len(a), pa.int64()) if x is None else pa.array(x) for x in (a, b, key, about)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(a), many))], ["a", "b", "key", "about", "crowded"])

    def parts(key: np.ndarray, ids: np.ndarray, about: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = key[1:] == key[:-1]
        shared = np.append(same, False) | np.append(False, same)
        key, ids, about = _once(key[shared], ids[shared], about[shared])
        order = np.lexsort((about & (1 << SIZE_BITS) - 1, key))
        key, ids, about = key[order], ids[order], about[order]
        a, b, dense, large = _meeting(key, ids, about, crowded)
        if len(a):
            yield rows(ids[a], ids[b], None, None, False)
        for at, many in ((dense, False), (large, True)):
            if len(at):
                yield rows(ids[at], None, key[at], about[at], many)

    @c.lean
    def run(batches):
        held, hot = [np.zeros(0, np.int64)] * 3, None  # rows of the last key, which may go on; a key that is passed on at once
        for b in batches:
            key, ids, about = (np.concatenate((x, y.to_numpy())) for x, y in zip(held, b.columns, strict=True))
            if hot is not None:
                end = np.searchsorted(key, hot, "right")
                if end:
                    yield rows(ids[:end], None, key[:end], about[:end], True)
                key, ids, about = key[end:], ids[end:], about[end:]
                held = [x[:0] for x in held]
                if not len(key):
                    continue
                hot = None
            if not len(key):
                continue
            last = np.searchsorted(key, key[-1], "left")
            if last:
                yield from parts(key[:last], ids[:last], about[:last])
            held = list(_once(key[last:], ids[last:], about[last:]))
            if crowded and len(held[0]) > crowded:
                hot = held[0][0]
                yield rows(held[1], None, held[0], held[2], True)
                held = [x[:0] for x in held]
        if len(held[0]) > 1:
            yield from parts(*held)

    dealt = keys.select("key", "id", "about").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long, key long, about long, crowded boolean")


def _tokens_of(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of lines, one after another, and how many each has."""
    values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, off in c.steps(lines, STEP_BYTES):
        chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        rows = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off]
        ts, te = _token_spans(chars, rows)
        values.append(_token_hashes(chars, ts, te))
        counts.append(np.diff(np.searchsorted(ts, rows)))
    return np.concatenate(values), np.concatenate(counts)


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, line, mark (number of tokens, BITS parities and, of long lines, pair_parities) for the lines named by wanted (doc_id, t, line_no, id)."""

    def rows(ids: list[int], lines: list[str]) -> Iterator[pa.RecordBatch]:
        column, lo, step = pa.array(lines, pa.string()), 0, max(1, STEP_BYTES // BITS)
        plain, n = _tokens_of(column)
        values, ends = numbered(plain, n), np.cumsum(n)
        while lo < len(ids):  # parities take BITS numbers a line while they are counted
            hi = min(lo + step, len(ids))
            odd = np.packbits(parities(values[ends[lo] - n[lo] : ends[hi - 1]], n[lo:hi], BITS), axis=1).view(np.int64)
            marks = [x.tobytes() for x in np.column_stack((n[lo:hi], odd))]
            for i in np.flatnonzero(n[lo:hi] >= LONG).tolist():
                marks[i] += pair_parities(plain[ends[lo + i] - n[lo + i] : ends[lo + i]]).tobytes()
            marks = pa.array(marks, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi], pa.int64()), column[lo:hi], marks], ["id", "line", "mark"])
            lo = hi

    @c.lean
    def run(batches):
        for b in batches:
            ids, found, size = [], [], 0
            for text, items in zip(b.column(0), b.column(1), strict=True):
                lines = text.as_py().split("\n")
                for x in items.as_py():
                    if x["line_no"] < len(lines):
                        ids.append(x["id"])
                        found.append(lines[x["line_no"]])
                        size += len(found[-1])
                if size > STEP_BYTES:
                    yield from rows(ids, found)
                    ids, found, size = [], [], 0
            yield from rows(ids, found)

    lists = wanted.groupBy(F.col("doc_id").alias("w_id"), F.col("t").alias("w_t")).agg(F.collect_set(F.struct("line_no", "id")).alias("items"))
    whole = _slim(docs).where("text is not null")
    met = whole.join(lists, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("t") == F.col("w_t")))
    return met.select("text", "items").mapInArrow(run, "id long, line string, mark binary").dropDuplicates(["id"])


def likely(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines whose marks can be those of linked ones."""
    size = 8 + BITS // 8  # bytes of what every mark has

    @c.lean
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            marks = [b.column(i).to_pylist() for i in (2, 3)]
            x, y = (np.frombuffer(b"".join(m[:size] for m in side), np.int64).reshape(b.num_rows, -1) for side in marks)
            k = limits(np.maximum(x[:, 0], y[:, 0]))
            ok = (np.abs(x[:, 0] - y[:, 0]) <= k) & (np.bitwise_count((x[:, 1:] ^ y[:, 1:]).view(np.uint64)).sum(1) <= 2 * k)
            for i in np.flatnonzero(ok & (np.minimum(x[:, 0], y[:, 0]) >= LONG)).tolist():
                ok[i] = pairs_alike(*(np.frombuffer(side[i], np.uint64, offset=size) for side in marks), k[i])
            yield b.select([0, 1]).filter(pa.array(ok))

    left = texts.select(F.col("id").alias("a"), F.col("mark").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("mark").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines that are linked."""

    @c.lean
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids, lines = np.concatenate((b.column(0).to_numpy(), b.column(1).to_numpy())), pa.concat_arrays(b.columns[2:])
            _, one, which = np.unique(ids, return_index=True, return_inverse=True)
            lines = lines.take(pa.array(one))
            keep = linked(lines, *_tokens_of(lines), which[: b.num_rows], which[b.num_rows :])
            yield b.select([0, 1]).filter(pa.array(keep))

    left = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))
    return likely(pairs, texts).join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def forest(lines: pa.Array, blocks: np.ndarray) -> list[tuple[int, int]]:
    """Links (places) that connect all lines which links connect, of one block or of two; of two, links between them alone are looked for."""
    values, n = _tokens_of(lines)
    order = np.argsort(n, kind="stable")
    odd = np.packbits(parities(numbered(values, n), n, BITS), axis=1).view(np.uint64)[order]
    some, blocks = odd[:, :SOME].copy(), blocks[order]
    ends = np.cumsum(n)[order]
    long = {i: pair_parities(values[ends[i] - n[order[i]] : ends[i]]) for i in np.flatnonzero(n[order] >= LONG).tolist()}
    two = blocks.min() != blocks.max()
    comp, out = np.arange(len(n)), []
    left, right, met = [], [], 0
    k = limits(n[order])
    end = np.searchsorted(n[order] - k, n[order], "right").tolist()  # lines from there on are too long
    for i in range(len(n) - 1):
        rest = np.flatnonzero(comp[i + 1 : end[i]] != comp[i]) + i + 1
        if two:
            rest = rest[blocks[rest] != blocks[i]]
        for bits in (some, odd):
            rest = rest[np.bitwise_count(bits[i] ^ bits[rest]).sum(1) <= 2 * k[rest]]
        if i in long:
            rest = np.array([j for j in rest.tolist() if pairs_alike(long[i], long[j], k[j])], np.int64)
        left.append(np.full(len(rest), i))
        right.append(rest)
        met += len(rest)
        if met >= AT_ONCE or i == len(n) - 2 and met:
            x, y = np.concatenate(left), np.concatenate(right)
            ok = linked(lines, values, n, order[x], order[y])
            for a, b in zip(x[ok].tolist(), y[ok].tolist(), strict=True):
                if comp[a] != comp[b]:
                    comp[comp == comp[b]] = comp[a]
                    out.append((int(order[a]), int(order[b])))
            left, right, met = [], [], 0
    return out


def gathered(own: c.Scratch, members: DataFrame) -> DataFrame:
    """members (key, id, about) of fewer and larger groups, so that lines which share a key still do. The leader of a group is its line with
    the largest groups; groups of one leader, and those whose lines all know another group's leader, become one where that makes fewer pairs."""
    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    sized = own.cut(members.join(sizes, "key"))
    scores = sized.groupBy("id").agg(F.sum("size").alias("score"))
    leaders = sized.join(scores, "id").groupBy("key").agg(F.max(F.struct("score", "id")).alias("leader"))
    led = own.cut(sized.select("key", "id", "size").join(leaders, "key"))
    homes = led.groupBy("id").agg(F.max("leader").alias("home"))
    ends = led.join(homes, "id").groupBy("key").agg(F.first("size").alias("size"), F.first("leader").alias("leader"), F.min("home").alias("lo"), F.max("home").alias("hi"))
    groups = own.cut(ends.select("key", "size", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("leader"))["id"].alias("leader")))
    lines = sized.join(groups.select("key", "leader"), "key").groupBy("leader", "id").agg(F.first("about").alias("about"))
    lines = own.cut(lines.select(F.col("leader").alias("key"), "id", "about"))
    fewer = lines.groupBy(F.col("key").alias("leader")).agg(F.count("*").alias("n"))
    fewer = fewer.join(groups.groupBy("leader").agg(F.sum(F.col("size") * F.col("size")).alias("apart")), "leader").where("n * n <= apart").select("leader")
    alone = groups.join(fewer, "leader", "left_anti").select("key")
    together = lines.join(fewer.withColumnRenamed("leader", "key"), "key", "left_semi")
    return together.unionByName(sized.join(alone, "key", "left_semi").drop("size"))


def linked_groups(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all lines of each group (key, id, about) which links connect."""

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(rows).combine_chunks()
        ids = group["id"].to_numpy()
        found = np.array(forest(group["line"].combine_chunks(), group["block"].to_numpy()), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ids[found[:, 0]]), pa.array(ids[found[:, 1]])], ["a", "b"])

    @c.lean
    def run(batches):
        held, name = [], None
        for b in batches:
            if not b.num_rows:
                continue
            at = np.stack([b.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held and name != tuple(at[:, lo]):
                    yield links(held)
                    held = []
                name = tuple(at[:, lo])
                held.append(b.slice(lo, hi - lo))
        if held:
            yield links(held)

    tokens_ = F.sum(F.col("about").bitwiseAND((1 << SIZE_BITS) - 1))
    sizes = members.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, tokens_ / BLOCK_TOKENS)).cast("int").alias("parts"))
    dealt = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "id", "block")
    met = dealt.join(texts.select("id", "line"), "id").select("key", "lo", "hi", "block", "id", "line")
    return met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(run, "a long, b long")


def _parity_parts(values: np.ndarray) -> list[tuple[int, ...]]:
    """Parts of the parity bits of a line's token hashes, one of which a linked line shares: 2k + 1 for each limit k that a pair can have."""
    odd, k, out = parities(values, np.array([len(values)]), BITS)[0], limit(len(values)), []
    for most in (k, k + 1):
        for i, part in enumerate(np.array_split(odd, 2 * most + 1)):
            out.append((most, i, int.from_bytes(np.packbits(part).tobytes())))
    return out


def _side_keys(keys: list[int], values: np.ndarray) -> list[tuple]:
    """(key, second part) for keys of a line of these token hashes: grams at the far end of its longer side, and parts of its parities where
    a linked line could be too short on both sides for that. The limit k of a pair is the line's own or one more."""
    acc, n = _sequence_hash(values), len(values)
    parts = _parity_parts(values)
    k = limit(n) + 1
    reach = SMALL * (k + 1) + k  # tokens in which a linked line has one of the k + 1 outermost segments, if unchanged
    own, _, at, size = line_keys(acc, np.array([0]), np.array([n]))
    places: dict[int, set[tuple[int, int]]] = {}
    for key, a, length in zip(c.signed(own).tolist(), at.tolist(), size.tolist(), strict=False):
        places.setdefault(key, set()).add((a, length))
    if n >= MANY - limit(MANY):
        for a, key in enumerate(c.signed(c.mix(c.span_hash(acc, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1)))).tolist()):
            places.setdefault(key, set()).add((a, GRAM))
    grams = c.signed(c.span_hash(acc, np.arange(n - SMALL + 1), np.arange(SMALL, n + 1))).tolist() if n >= SMALL else []
    tail, head = [g | 1 for g in grams[max(0, n - reach) :]], [g & ~1 for g in grams[: max(0, reach - SMALL + 1)]]
    out = set()
    for key in keys:
        for at, size in places.get(key, ()):
            before, behind = at, n - at - size
            side = max(before, behind)
            if side < reach + 3 * k + SMALL:
                out.update((key, p) for p in parts)
            if side >= reach and behind >= before - 2 * k:
                out.update((key, g) for g in tail)
            if side >= reach and before >= behind - 2 * k:
                out.update((key, g) for g in head)
    return list(out)


def finer_keys(members: DataFrame, texts: DataFrame) -> DataFrame:
    """members with keys of two parts: the old one and a gram of the side of the line that is longer."""

    @c.lean
    def run(batches):
        for b in batches:
            at, parts = [], []
            for i, (keys, line) in enumerate(zip(b.column(0), b.column(1), strict=True)):
                chars = np.frombuffer(line.as_py().encode("utf-32-le"), np.uint32)
                x = _token_hashes(chars, *_token_spans(chars, np.array([0, len(chars)])))
                more = [hash(pair) for pair in _side_keys(keys.as_py(), x)]
                at += [i] * len(more)
                parts += more
            rest = b.select(b.schema.names[2:]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), *rest.columns], ["key", *rest.schema.names])

    names = [x for x in members.columns if x != "key"]
    lists = members.groupBy(*names).agg(F.collect_list("key").alias("keys"))  # a line has no more keys than tokens, or a dozen
    joined = lists.join(texts.select("id", "line"), "id").select("keys", "line", *names)
    schema = "key long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.select(names).schema.fields)
    return joined.mapInArrow(run, schema)


def banded(members: DataFrame) -> DataFrame:
    """members (key, id, about) with `band` and `narrow`, a key of key and band: one row for each band of the number of tokens in which a
    linked line that is no shorter can be."""
    n = F.col("about").bitwiseAND((1 << SIZE_BITS) - 1)
    longest = F.least(F.lit((1 << SIZE_BITS) - 1), n + F.greatest(F.lit(2), F.floor(n / (STEP - 1)) + 1))
    first, last = (F.floor(F.log(F.greatest(x, F.lit(1))) / math.log(BAND_WIDTH)).cast("int") for x in (n, longest))
    return members.withColumn("band", F.explode(F.sequence(first, last))).withColumn("narrow", F.xxhash64("key", "band"))


def _links(own: c.Scratch, found: DataFrame, seen: dict, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all lines which links connect, by what candidates() found and counted."""
    count = F.count("key").alias("members"), F.count_if("crowded").alias("crowded")
    tables, some = [found], seen["members"] > seen["crowded"]
    if seen["crowded"]:
        bands = own.cut(banded(found.where("crowded").select("key", F.col("a").alias("id"), "about").distinct()))
        found, seen = own.measured(candidates(bands.select(F.col("narrow").alias("key"), "id", "about"), LARGE * rounds.CROWDED), *count)
        tables.append(found)
        some = some or seen["members"] > seen["crowded"]
        if seen["crowded"]:
            over = found.where("crowded").select(F.col("key").alias("narrow")).distinct()
            finer = finer_keys(bands.join(over, "narrow", "left_semi").drop("narrow"), texts)
            found, seen = own.measured(candidates(finer.select(F.xxhash64("key", "band").alias("key"), "id", "about"), None), *count)
            tables.append(found)
            some = some or seen["members"] > 0
    found = functools.reduce(DataFrame.unionByName, tables)
    links = verified(found.where("b is not null").select("a", "b").distinct(), texts)
    if some:
        members = found.where("key is not null and not crowded").select("key", F.col("a").alias("id"), "about")
        links = links.unionByName(linked_groups(gathered(own, members), texts))
    return links


def _classes(own: c.Scratch, docs: DataFrame) -> DataFrame:
    """Rows of line_classes, with t, the hash of the whole text."""
    lines = own.cut(line_table(docs))
    firsts = own.cut(lines.groupBy("h").agg(F.min(F.struct("doc_id", "line_no", "t")).alias("first")).withColumnRenamed("h", "id"))
    found, seen = own.measured(candidates(key_table(docs), rounds.CROWDED), F.count("key").alias("members"), F.count_if("crowded").alias("crowded"))
    links = None
    if seen["n"]:
        ids = found.select(F.explode(F.array("a", "b")).alias("id")).where("id is not null").distinct()
        wanted = firsts.join(ids, "id").select("first.doc_id", "first.t", "first.line_no", "id")
        texts = own.cut(line_texts(docs, wanted))
        links = _links(own, found, seen, texts)
        links, seen = own.measured(links)
    comps = c.components(own, links) if seen["n"] else None
    out = lines.withColumnRenamed("h", "id")
    if comps is None:
        out = out.join(firsts, "id").withColumn("f", F.col("first"))
    else:
        # only linked texts need the first line of their class; the rest are classes of their own
        comps = own.cut(firsts.join(comps.withColumnRenamed("node", "id"), "id"))
        class_first = own.cut(comps.groupBy("component").agg(F.min("first").alias("f")))
        linked_first = comps.join(class_first, "component").select(F.col("id").alias("l_id"), "f")
        firsts = own.cut(firsts.join(linked_first, F.col("id") == F.col("l_id"), "left").select("id", F.coalesce("f", "first").alias("f")))
        out = out.join(firsts, "id")
    return out.select(
        "doc_id",
        "t",
        "line_no",
        "n_chars",
        F.col("f.doc_id").alias("class_doc_id"),
        F.col("f.line_no").alias("class_line_no"),
        (F.col("f.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("f.line_no") == F.col("line_no")) & (F.col("f.t") == F.col("t"))).alias("kept"),
    )


def line_classes(docs: DataFrame) -> DataFrame:
    """One row for each line that is not blank: doc_id, line_no, n_chars, class_doc_id and class_line_no (the first line of the class
    that links reach), kept (this is that first line)."""
    own = c.Scratch(docs.sparkSession)
    out = c.cut(_classes(own, docs).drop("t"))
    own.clear()
    return out


@F.arrow_udf(StringType())
@c.lean
def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts without the lines of the given numbers (from 0); null if no line that is not blank is left."""
    for texts, numbers in batches:
        out = []
        for text, gone in zip(texts, numbers, strict=True):
            if not text.is_valid or not gone.is_valid:
                out.append(None)
                continue
            away = set(gone.as_py())
            lines = [x for i, x in enumerate(text.as_py().split("\n")) if i not in away]
            out.append("\n".join(lines) if any(x.strip(BLANKS) for x in lines) else None)
        yield pa.array(out, pa.string())


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with the lines removed that are not the first of their class; documents left without a line that is not blank are dropped,
    documents that had no text stay. All columns are kept; n_chars, if there, is that of a changed text."""
    own = c.Scratch(docs.sparkSession)
    gone_col, at, key = c.fresh("gone", docs), c.fresh("at", docs), c.fresh("text_key", docs)
    gone = _classes(own, docs).where("not kept").groupBy(F.col("doc_id").alias(at), F.col("t").alias(key))
    gone = c.cut(gone.agg(F.collect_set("line_no").alias(gone_col)))
    own.clear()
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col(at)) & (c.text_hash() == F.col(key)), "left")
    changed = F.col(gone_col).isNotNull()
    left = c.fresh("left", joined)
    # one pass over a text's lines, of changed texts alone
    cut = joined.withColumn(left, _without(F.when(changed, F.col("text").cast("string")), F.col(gone_col)))
    kept = cut.where(~changed | F.col(left).isNotNull())
    out = kept.withColumn("text", F.when(changed, F.col(left)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.drop(gone_col, at, key, left)
