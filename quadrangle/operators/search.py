"""Ranked search by name, and lookup by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.text import normalized_text
from quadrangle.sources.schema import CATEGORIES

DEFAULT_LIMIT, MAX_LIMIT, MIN_QUERY = 10, 25, 2
PUBLIC = ("id", "name", "category", "city", "state", "country", "website", "logo_url")


class SearchError(ValueError):
    """A request that cannot be served; code is INVALID_QUERY, NOT_FOUND or RATE_LIMITED."""

    def __init__(self, code: str, message: str, status: int):
        super().__init__(message)
        self.code, self.status = code, status


def checked(query: object, limit: object = None, category: str | None = None, categories: tuple[str, ...] = CATEGORIES) -> tuple[str, int]:
    """The query in normal form and the limit, or a SearchError."""
    text = normalized_text(str(query or ""))
    if len(text) < MIN_QUERY:
        raise SearchError("INVALID_QUERY", f"The query must have {MIN_QUERY} characters at least.", 400)
    try:
        n = DEFAULT_LIMIT if limit is None else int(str(limit))
    except ValueError:
        n = 0
    if not 1 <= n <= MAX_LIMIT:
        raise SearchError("INVALID_QUERY", f"The limit must be from 1 to {MAX_LIMIT}.", 400)
    if category is not None and category not in categories:
        raise SearchError("INVALID_QUERY", "Unknown category.", 400)
    return text, n


def tier(name: Column, query: str) -> Column:
    """0 for the name itself, 1 for its beginning, 2 for a part, 3 for a spelling close by, else null."""
    edits = max(1, len(query) // 4)
    return (
        F.when(name == query, 0)
        .when(F.startswith(name, F.lit(query)), 1)
        .when(F.contains(name, F.lit(query)), 2)
        .when(F.levenshtein(name, F.lit(query), edits) >= 0, 3)
    )


def search(rows: DataFrame, query: object, limit: object = None, category: str | None = None, aliases: DataFrame | None = None, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """id, name, tier, distance of the best matches: by tier, then edit distance, name and id. An alias that equals the query
    puts its entity into tier 0. A top-n over one scan; the name column must be `normalized_name`."""
    text, n = checked(query, limit, category, categories)
    some = rows.where(F.col("category") == category) if category else rows
    name = F.col("normalized_name")
    found = some.withColumn("tier", tier(name, text))
    if aliases is not None:
        hits = aliases.where(F.col("normalized_alias") == text).select(F.col("entity_id").alias("id"), F.lit(True).alias("_alias")).distinct()
        found = found.join(hits, "id", "left").withColumn("tier", F.when(F.col("_alias"), 0).otherwise(F.col("tier"))).drop("_alias")
    found = found.where(F.col("tier").isNotNull()).withColumn("distance", F.levenshtein(name, F.lit(text)))
    order = ["tier", "distance", "normalized_name", "id"]
    return found.orderBy(*order).limit(n).select("id", "name", "normalized_name", "tier", "distance")


def public(rows: DataFrame, logo_base: str) -> DataFrame:
    """What the service shows of a row; where it comes from is left out."""
    url = F.when(F.coalesce(F.col("logo_key"), F.lit("")) != "", F.concat(F.lit(logo_base.rstrip("/") + "/"), "logo_key"))
    return rows.withColumn("logo_url", url).select(*PUBLIC)


def lookup(rows: DataFrame, entity_id: str, logo_base: str = "") -> DataFrame:
    return public(rows.where(F.col("id") == entity_id), logo_base)


def lookup_one(rows: DataFrame, entity_id: str, logo_base: str = "") -> dict:
    row = lookup(rows, entity_id, logo_base).first()
    if row is None:
        raise SearchError("NOT_FOUND", "There is no such entity.", 404)
    return row.asDict()
