"""From raw documents to packed training bins: toxicity, line dedup, near dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; run() writes each stage's rows as
a table in the shared folder and reads it back. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.llm import common, linedup, minhash, packing, suffixdedup, toxicity

#: No stage but the packing can be said in SQL (training, edit distances, suffixes); tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    score = common.fresh("toxicity", docs)
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal or linked lines the first stays; documents that lose every line go."""
    return linedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 or more of their five-word shingles the one with the smallest doc_id stays."""
    return minhash.first_of_each(docs, words=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that are found twice or more go; so do documents that lose all their text."""
    return suffixdedup.cut_repeats(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document with its bin."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_bins),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = common.Scratch(spark)
    docs = last = None
    for _, stage in STAGES:
        docs = common.table(spark, sf_dir, "documents") if docs is None else docs
        docs = own.cut(stage(spark, docs, sf_dir))
        own.drop(last)
        last = docs
    return docs
