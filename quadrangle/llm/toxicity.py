"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the presence of hashed words and word prefixes is trained with numpy from confirmed toxic examples and unlabelled
text. The risk is pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) with the logistic loss, and when the bracket turns negative
its gradient step is reversed; pi, the class prior, is the share of toxic rows among the labels that training may see.
Words are runs of bytes other than ASCII punctuation, digits and controls, A-Z lower-cased. doc_id, lang, source and
labels never enter a score.

Fitting uses a bounded sample: at most `positives` toxic documents and `unlabelled` documents, the ones with the smallest
hash of doc_id, each with its whole text. Their features are counted and chosen in executors; a bit for each chosen feature and
document is all that the driver gets. Everything else runs over all rows.

Defined cases: null or empty text scores as a text without any known word. Without toxic examples in the training part
every score is 0. A null label does not count. Repeated label rows count as toxic if one of them is. A null doc_id is not
held out and not used in training. Other columns of the input are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm import common as c

#: Prefix lengths in bytes that are features beside the whole word: inflected forms share them.
PREFIXES = (4, 6)
POSITIVES, UNLABELLED, FEATURES = 2500, 7500, 768
#: Bytes of text of one vectorised step, which takes some thirty times as much.
STEP_BYTES = 1 << 19
#: Top bits of a feature's hash that are looked up before the exact search.
SCREEN_BITS = 20


@functools.cache
def _separators() -> np.ndarray:
    t = np.zeros(256, bool)
    t[:128] = [not chr(i).isalpha() for i in range(128)]
    return t


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words and of the prefixes of longer words, with their row numbers."""
    data = c.lower_bytes()[data]
    start, end, row = c.spans(data, offsets, _separators())
    prefix = c.prefix_hash(data)
    found, rows = [c.word_hash(data, start, end)], [row]
    for k in PREFIXES:
        longer = np.flatnonzero(end - start > k)
        found.append(c.mix(c.span_hash(prefix, start[longer], start[longer] + k) + np.uint64(k)))
        rows.append(row[longer])
    return np.concatenate(found), np.concatenate(rows)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features_of(docs: DataFrame) -> DataFrame:
    """p, doc_id, t and f, the distinct features of the text, for rows p, doc_id, t, text."""

    @c.lean
    def run(batches):
        for b in batches:
            for lo, hi, data, off in c.steps(b.column(3), STEP_BYTES):
                f, row = word_features(data, off)
                each = [np.unique(x) for x in np.split(f[np.argsort(row, kind="stable")], np.cumsum(np.bincount(row, minlength=hi - lo))[:-1])]
                items = pa.array(c.signed(np.concatenate(each)))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], c.list_array(items, [len(x) for x in each])], ["p", "doc_id", "t", "f"])

    return docs.select("p", "doc_id", "t", F.col("text").cast("string")).mapInArrow(run, "p boolean, doc_id long, t long, f array<long>")


def choose_features(rows: DataFrame, positives: int, unlabelled: int, features: int = FEATURES) -> np.ndarray:
    """Sorted hashes of the features that tell positive rows from unlabelled ones best; counted in executors."""
    counts = rows.select("p", F.explode("f").alias("f")).groupBy("f").agg(F.count_if("p").alias("n_p"), F.count_if(~F.col("p")).alias("n_u"))
    p, u = (F.col("n_p") + 0.5) / (positives + 1), (F.col("n_u") + 0.5) / (unlabelled + 1)
    gain = F.abs(F.log(p / u)) * F.sqrt(p + u)
    best = counts.where("n_p + n_u >= 4").select("f", F.round(gain, 9).alias("gain")).orderBy(F.desc("gain"), "f").limit(features)
    return np.sort(best.select("f").toArrow().column("f").to_numpy().view(np.uint64))


def _presence(rows: DataFrame, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row whether it is positive and which chosen features it has; a bit for each feature is what reaches the driver."""

    @c.lean
    def run(batches):
        for b in batches:
            x = np.zeros((len(b), len(chosen)), bool)
            lists = b.column(1)
            f = lists.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(chosen, f), len(chosen) - 1)
            hit = chosen[at] == f
            x[row[hit], at[hit]] = True
            bits = np.packbits(x, axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), c.binary_array(bits.ravel(), np.full(len(b), bits.shape[1]))], ["p", "x"])

    out = rows.select("p", "f").mapInArrow(run, "p boolean, x binary").toArrow()
    packed = np.frombuffer(b"".join(out.column("x").to_pylist()), np.uint8).reshape(len(out), -1)
    return np.array(out.column("p").to_pylist(), bool), np.unpackbits(packed, axis=1)[:, : len(chosen)].astype(np.float32)


def fit(xp: np.ndarray, xu: np.ndarray, prior: float, epochs: int = 300) -> tuple[np.ndarray, float]:
    """Weights and a bias from the features' presence in positive and unlabelled rows."""
    w, b = np.zeros(xp.shape[1], np.float32), np.float32(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for step in range(1, epochs + 1):
        zp, zu = (np.clip(x @ w + b, -30, 30) for x in (xp, xu))
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        gp, gu = prior * sp / len(sp), su / len(su)
        if negative >= 0:
            coef_p, coef_u = -prior * (1 - sp) / len(sp) - gp, gu
        else:  # the estimate of the negatives' risk must not fall below zero: step back from it
            coef_p, coef_u = gp, -gu
        grad = np.append(coef_p @ xp + coef_u @ xu + np.float32(1e-4) * w, coef_p.sum() + coef_u.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w.astype(np.float32), float(b)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED):
    """Features, weights and bias, or None without toxic examples. Only rows that are not held out are seen."""
    own = c.Scratch(docs.sparkSession)
    seen = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    seen = own.cut(seen.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    n, toxic = seen.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    if not toxic:
        return None
    slim = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), c.text_hash().alias("t"), "text")
    slim = slim.where(~held_out(F.col("doc_id")))
    # texts are chosen by their keys, each once: as many as asked for at most, however often a doc_id is repeated
    keys, order = slim.select("doc_id", "t"), F.xxhash64(F.col("doc_id"), F.lit(7))
    some_p = keys.join(seen.where("toxic = 1"), "doc_id", "left_semi").distinct().orderBy(order, "doc_id", "t").limit(positives)
    some_u = keys.distinct().orderBy(order, "doc_id", "t").limit(unlabelled)
    chosen = own.cut(some_p.select("doc_id", "t", F.lit(True).alias("p")).unionByName(some_u.select("doc_id", "t", F.lit(False).alias("p"))))
    rows = _features_of(slim.join(F.broadcast(chosen), ["doc_id", "t"]))  # at most positives + unlabelled keys
    rows = own.cut(rows.groupBy("doc_id", "t", "p").agg(F.any_value("f").alias("f")).select("p", "f"))
    n_p, n_u = rows.agg(F.count_if("p"), F.count_if(~F.col("p"))).first()
    if not n_p or not n_u:
        return None
    prior = min(max(toxic / n, 1e-4), 0.9)
    found = choose_features(rows, n_p, n_u)
    if not len(found):
        return np.zeros(1, np.uint64), np.zeros(1, np.float32), float(np.log(prior / (1 - prior)))
    p, x = _presence(rows, found)
    own.clear()
    return found, *fit(x[p], x[~p], prior)


def _scores(text: pa.Array, keys: np.ndarray, w: np.ndarray, bias: float, screen: np.ndarray) -> np.ndarray:
    out = np.zeros(len(text))
    for lo, hi, data, off in c.steps(text, STEP_BYTES):
        f, row = word_features(data, off)
        maybe = np.flatnonzero(screen[(f >> np.uint64(64 - SCREEN_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, f[maybe]), len(keys) - 1)
        hit = keys[at] == f[maybe]
        both = np.unique(row[maybe][hit] * len(keys) + at[hit])
        z = np.bincount(both // len(keys), w[both % len(keys)], hi - lo)
        out[lo:hi] = 1 / (1 + np.exp(-np.clip(z + bias, -30, 30)))
    return out


def with_score(docs: DataFrame, model, name: str = "score") -> DataFrame:
    """docs with a column of scores (0 to 1) under a name that docs does not have."""
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    known = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights, whatever the input

    @F.arrow_udf("double")
    @c.lean
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, w, bias = known.value
        screen = np.zeros(1 << SCREEN_BITS, bool)
        screen[(keys >> np.uint64(64 - SCREEN_BITS)).astype(np.int64)] = True
        for text in texts:
            yield pa.array(_scores(text, keys, w, bias, screen))

    return docs.withColumn(name, score(F.col("text").cast("string")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **sample: int) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs, by a model trained on the rows that are not held out."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = with_score(slim, train(docs, labels, **sample))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
