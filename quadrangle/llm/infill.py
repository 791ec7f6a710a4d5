"""Fill-in-middle: a text's lines are cut into prefix, middle and suffix, which are written in another order behind marks.

The lines come from the Split pre-tokenizer of the tokenizers library with isolated regex matches, so nothing is trained: its
code-point offsets are the places where a text may be cut. The number of offsets is n; two hashes of the doc_id pick two ranks among
0 to n, the offsets of those ranks give the three slices, a third hash says whether the text is changed at all and a fourth which of
the two orders it gets. The choice depends on seed and doc_id alone, so partitions, retries and reruns agree.

Work is by row: no shuffle, nothing collected, one batch of texts in memory at a time, results sent back in parts of `STEP_BYTES`.

Defined cases: null text is empty, and an empty text stays plain with n = 0; so does a text that holds a mark, which could not be
taken apart again. A null doc_id hashes as an empty string. Rows that share a doc_id are cut at the same ranks. Texts of any length are
cut whole. Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.common import STEP_BYTES

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@functools.cache
def _splitter(pattern: str):
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(pattern), behavior="isolated")


def offsets(text: str, pattern: str = LINES) -> list[int]:
    """The code-point offsets at which units end, in order."""
    return [end for _, (_, end) in _splitter(pattern).pre_tokenize_str(text)] if text else []


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers: the first digits of the sha256 of seed:doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def rearranged(doc_id: int | None, text: str, seed: int = 7, percent: int = 100, spm_percent: int = 50, pattern: str = LINES) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text."""
    ends = offsets(text, pattern)
    n = len(ends)
    a, b, chance, order = draws(seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or chance % 100 >= percent:
        return n, PLAIN, None, None, text
    first, second = sorted((a % (n + 1), b % (n + 1)))
    at = [0, *ends]
    prefix, middle, suffix = text[: at[first]], text[at[first] : at[second]], text[at[second] :]
    if order % 100 < spm_percent:
        form, output = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, at[first], at[second] - at[first], output


def transform(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, pattern: str = LINES) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row of docs (doc_id, text). percent: how many texts of a hundred are
    changed; spm_percent: how many of these have the suffix first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            rows, size = [], 0
            for doc_id, text in zip(b.column(0), b.column(1), strict=True):
                key = doc_id.as_py()
                rows.append((key, *rearranged(key, text.as_py() or "", seed, percent, spm_percent, pattern)))
                size += 4 * len(rows[-1][-1])
                if size >= STEP_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text from its changed form: the parts between the marks in the order of the text."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == PSM, F.concat(parts[1], parts[3], parts[2])).when(form == SPM, F.concat(parts[2], parts[3], parts[1])).otherwise(output)
