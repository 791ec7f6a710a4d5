"""What is left to evaluate, and a balanced sample of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.text import sql_blank

FAILED = ("error", "no_candidates")


def without_logo(institutions: DataFrame) -> DataFrame:
    return institutions.where(sql_blank("logo_key") & ~sql_blank("website"))


def processed(manifest: DataFrame, refresh_failed: bool = False, key: str = "institution_id") -> DataFrame:
    """Keys that need no new evaluation; with refresh_failed, those whose rows all failed are evaluated again."""
    done = manifest.groupBy(key).agg(F.bool_and(F.coalesce(F.col("status").isin(*FAILED), F.lit(False))).alias("failed"))
    return (done.where("not failed") if refresh_failed else done).select(key)


def unprocessed(institutions: DataFrame, done: DataFrame, key: str = "institution_id") -> DataFrame:
    return institutions.join(done.select(F.col(key).alias("id")), "id", "left_anti")


def seeded(seed: str, key: str) -> Column:
    """An order that depends on the seed and the key alone, not on the order of the rows."""
    return F.sha2(F.concat(F.lit(seed), F.lit("|"), F.col(key).cast("string")), 256)


def balanced(rows: DataFrame, limit: int, seed: str, categories: tuple[str, ...] = ("college", "high_school"), key: str = "id") -> DataFrame:
    """limit rows: an equal part of each category as far as it has them, the rest from all that are left. Each part is a
    top-n; `place` is the row's place in the sample."""
    part = limit // len(categories)
    order = seeded(seed, key)
    chosen = None
    for c in categories:
        some = rows.where(F.col("category") == c).orderBy(order).limit(part)
        chosen = some if chosen is None else chosen.unionByName(some)
    ids = chosen.select(key, F.lit(0).alias("turn"))
    # the chosen come first, then others in seeded order, up to the limit: one more top-n
    both = rows.join(F.broadcast(ids), key, "left")  # at most limit rows
    return both.orderBy(F.coalesce("turn", F.lit(1)), order).limit(limit).drop("turn")
