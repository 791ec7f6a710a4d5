"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Four counts of every whole text give the base rule. Documents that pass it meet the other rules one by one and leave at the
first that rejects them. The order comes from a sample: each rule's cost is the time that it takes over the sample beyond a
plain scan, its selectivity the share of sampled documents that it rejects, and rules run by rejection per cost, highest
first. The verdict does not depend on the order.

The sample is bounded: at most `SAMPLE` documents, those with the smallest hash of doc_id. Counts and rules see all rows.

Defined cases: null text is empty; a text without a word fails the base rule. Repeated rows and null doc_ids are rows like
any other. Other columns are kept by `keep` and ignored by `assess`.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c

SAMPLE = 2000
BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words in windows of WINDOW words that are found twice or more."""
    n = F.size(words)
    starts = F.slice(words, 1, F.greatest(n - (WINDOW - 1), F.lit(0)))

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(WINDOW)]

    def exact(_: Column) -> Column:
        named = F.transform(starts, lambda w, i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i")))

        def places(s: Column) -> Column:
            same = lambda k, j: F.coalesce(F.get(s, k)["w"] == F.get(s, j)["w"], F.lit(False))
            twice = F.filter(s, lambda x, k: same(k, k + 1) | same(k, k - 1))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def covered(p: Column) -> Column:
            new = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(new, F.lit(0), lambda a, x: a + x)

        return _let(_let(F.array_sort(named), places), covered)

    # equal windows have equal hashes: without a repeated hash there is none
    hashes = F.transform(starts, lambda w, i: F.xxhash64(*window(i)))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(h)))


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """docs with a struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words under a new name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(words: Column) -> Column:
        return _let(
            lines,
            lambda ls: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                symbols.cast("long").alias("n_symbols"),
                F.size(ls).cast("long").alias("n_lines"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                _repeated_words(words).cast("long").alias("n_repeat_words"),
            ),
        )

    return docs.withColumn(name, _let(F.array_remove(F.split(text, BLANK, -1), ""), counts))


def base_rule(s: Column) -> Column:
    """True for documents that fail."""
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def rules(s: Column) -> dict[str, Column]:
    """By name, what rejects a document that passes the base rule."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return {
        "symbols": 10 * s["n_symbols"] > s["n_words"],
        "word_length": (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 15 * s["n_words"]),
        "repeated_lines": 10 * s["n_dup_lines"] > 3 * s["n_lines"],
        "letters": 100 * F.size(F.filter(F.split(text, BLANK, -1), lambda w: w.rlike(r"\p{L}"))) < 60 * s["n_words"],
        "ellipses": 10 * F.regexp_count(text, F.lit(r"(?dm)(\.\.\.|…)$")) > 3 * s["n_lines"],  # d: lines end at \n alone
        "bullets": 10 * F.regexp_count(text, F.lit(r"(?dm)^[•‣*-]\x20")) > 9 * s["n_lines"],
    }


def ordered(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, float, float]]:
    """(rule, rejected share, seconds) in the order in which rules should run, measured on a sample."""
    some = with_counts(c.some_rows(docs.select("doc_id", "text"), "doc_id", sample, 11), "s")
    some = c.cut(some.where(~base_rule(F.col("s"))).select("text", "s"))
    n = some.count()

    def timed(rejects: Column) -> tuple[int, float]:
        began = time.perf_counter()
        hits = some.agg(F.count_if(rejects)).first()[0]
        return hits, time.perf_counter() - began

    timed(F.lit(False))
    scan = min(timed(F.length("text") < 0)[1] for _ in range(2))
    measured = []
    for name, rejects in rules(F.col("s")).items():
        hits, seconds = timed(rejects)
        measured.append((name, hits / max(n, 1), max(seconds - scan, 1e-4)))
    return sorted(measured, key=lambda m: (-m[1] / m[2], m[2]))


def _verdict(s: Column, order: list[str]) -> Column:
    known = rules(s)
    out = F.when(base_rule(s), F.lit(False))
    for name in order:
        out = out.when(known[name], F.lit(False))
    return out.otherwise(F.lit(True))


def assess(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every row of docs."""
    order = order or [name for name, _, _ in ordered(docs)]
    s = F.col("s")
    rows = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "s")
    return rows.select(
        "doc_id",
        *(s[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_rule(s).alias("base_failed"),
        _verdict(s, order).alias("kept"),
    )


def keep(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """docs without the rows that a rule rejects."""
    order = order or [name for name, _, _ in ordered(docs)]
    name = c.fresh("counts", docs)
    return with_counts(docs, name).where(_verdict(F.col(name), order)).drop(name)
