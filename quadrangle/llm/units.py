"""A worker's memory of encoded units: short strings at whose borders a tokenizer starts anew, found by a 64-bit hash."""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Callable

import numpy as np

#: Bytes of units that a worker remembers before it starts afresh; units that go to the library at once.
UNIT_BYTES, AT_ONCE = 1 << 25, 1 << 14
#: Signs that are a piece of their own behind a letter or digit when a unit ends with them.
SIGNS = ".,;:!?"
LATIN_END, DOTTED_I = chr(0x250), chr(0x130)


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.cache
def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: graphic ones themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}


@functools.cache
def shown_bytes() -> dict[int, str]:
    return {b: ch for ch, b in byte_characters().items()}


def as_shown(text: str) -> str:
    """The text's bytes as the vocabulary shows them."""
    return text.encode().decode("latin-1").translate(shown_bytes())


def latin_word(text: str) -> bool:
    """Letters up to U+024F: one piece of either tokenizer's pattern whatever the library's Unicode version."""
    return text.isalpha() and (text.isascii() or max(text) < LATIN_END)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    alnum, sign = np.zeros(256, bool), np.zeros(256, np.int64)
    alnum[[b for b in range(128) if chr(b).isalnum()]] = True
    sign[[ord(s) for s in SIGNS]] = np.arange(1, len(SIGNS) + 1)
    return alnum, sign


def last_signs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each unit the code of the sign at its end that is a piece of its own, or 0."""
    alnum, sign = _tables()
    if not len(end):
        return np.zeros(0, np.int64)
    return np.where((end - start > 1) & alnum[data[np.maximum(end - 2, 0)]], sign[data[np.maximum(end - 1, 0)]], 0)


class Units:
    """Ids by unit. Unit 0 has the given ids, units from 1 on are SIGNS. word(unit) gives the form in which the model merges a
    unit that is one piece of the pattern, or None; any other unit goes through the whole library. With more units than `most`
    it starts afresh."""

    def __init__(self, path: str, word: Callable[[str], str | None], zero: list[int], most: int):
        self.path, self.word, self.zero, self.most = path, word, zero, most
        self._clear()

    def _clear(self) -> None:
        self.code: dict[int, int] = {}
        self.bytes = 0
        self.ids, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._add([self.zero, *self._library(list(SIGNS))])

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, found: list[list[int]]) -> None:
        count = np.fromiter(map(len, found), np.int64, len(found))
        self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(count) - count))
        self.count = np.concatenate((self.count, count))
        self.ids = np.concatenate((self.ids, np.fromiter(itertools.chain.from_iterable(found), np.int32, int(count.sum()))))

    def _learn(self, new: list[str]) -> None:
        merge, word = tokenizer(self.path).model.tokenize, self.word
        for lo in range(0, len(new), AT_ONCE):
            some = new[lo : lo + AT_ONCE]
            forms = [word(u) for u in some]
            found = [[t.id for t in merge(f)] if f else None for f in forms]
            others = [i for i, f in enumerate(found) if f is None]
            for i, ids in zip(others, self._library([some[i] for i in others]), strict=True):
                found[i] = ids
            self._add(found)

    def codes(self, h: np.ndarray, text_of: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """The unit numbers for hashes; text_of(places) gives the texts of units that are new."""
        if len(self.code) > self.most or self.bytes > UNIT_BYTES:
            self._clear()
        each, first, which = np.unique(h, return_index=True, return_inverse=True)
        get = self.code.get
        code = np.array([get(x, -1) for x in each.tolist()], np.int64)
        if len(new := np.flatnonzero(code < 0)):
            texts = text_of(first[new])
            code[new] = len(self.count) + np.arange(len(new))
            self._learn(texts)
            self.bytes += sum(map(len, texts))
            self.code.update(zip(each[new].tolist(), code[new].tolist(), strict=True))
        return code[which]

    def gather(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of units, one after another, and the end of each unit's ids."""
        count = self.count[unit]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[unit] - ends + count, count) + np.arange(total)], ends


def in_order(code: np.ndarray, sign: np.ndarray, row: np.ndarray, rows: int, closing: bool) -> tuple[np.ndarray, np.ndarray]:
    """Unit numbers with each unit's sign behind it, and unit 0 at the end of each row if closing; and how many each row has."""
    signed = sign > 0
    per_row = np.bincount(row, 1 + signed, rows).astype(np.int64) + closing
    out = np.zeros(int(per_row.sum()), np.int64)
    place = np.cumsum(1 + signed) - 1 - signed + (row if closing else 0)
    out[place] = code
    out[place[signed] + 1] = sign[signed]
    return out, per_row
