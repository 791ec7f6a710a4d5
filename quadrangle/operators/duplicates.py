"""Duplicate institutions: the audits, and the plan that merges them.

Groups are formed by one shuffle on the group key. The numbers of a group come from combining aggregates; its rows stay rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.text import normalize_name, present

#: Fields that can be in conflict, in the order in which they are reported.
FIELDS = ("name", "city", "state", "country", "website", "logo_key", "source_year")
COUNTED = ("name", "normalized_name", "city", "state", "country", "website", "logo_key", "source_year")


def groups(rows: DataFrame, keys: list[Column], kind: Column) -> DataFrame:
    """group_key, size, sources, candidate_type of the keys that two or more rows have. kind may use `sources`, the number of
    different sources."""
    key = F.concat_ws(" | ", *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    found = rows.groupBy(key.alias("group_key")).agg(F.count("*").alias("size"), F.count_distinct("source").alias("sources"))
    return found.where("size > 1").withColumn("candidate_type", kind)


def _kind(one: str) -> Column:
    return F.when(F.col("sources") > 1, "cross_source").otherwise(one)


def source_key_collisions(rows: DataFrame) -> DataFrame:
    """Source keys that are not unique."""
    return groups(rows, [F.col("source"), F.col("source_id")], F.lit("same_source_location"))


def _location_keys(city: bool) -> list[Column]:
    keys = [F.col("category"), F.col("state"), F.col("normalized_name")]
    return [*keys, F.col("city")] if city else keys


def exact_location(rows: DataFrame) -> DataFrame:
    """Groups with one category, state, name and city as they are written; rows without a city take no part."""
    return groups(rows.where(present("city")), _location_keys(True), _kind("same_source_location"))


def same_name_state(rows: DataFrame) -> DataFrame:
    return groups(rows, _location_keys(False), F.lit("same_name_state"))


def with_members(rows: DataFrame, found: DataFrame, keys: list[Column]) -> DataFrame:
    """The rows of the groups found, each with what is known of its group; a group of any size stays rows."""
    key = F.concat_ws(" | ", *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    return rows.withColumn("group_key", key).join(found, "group_key")


def report_order() -> list[Column]:
    """Largest groups first, then by key in the order of people's alphabets."""
    return [F.desc("size"), F.expr("collate(group_key, 'UNICODE')"), F.col("group_key")]


def totals(audits: dict[str, DataFrame]) -> DataFrame:
    """audit, groups, rows."""
    parts = [a.agg(F.count("*").alias("groups"), F.coalesce(F.sum("size"), F.lit(0)).alias("rows")).select(F.lit(n).alias("audit"), "groups", "rows") for n, a in audits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def completeness() -> Column:
    return sum((present(c).cast("int") for c in COUNTED), F.lit(0))


def canonical_order() -> Column:
    """Smallest for the row that stays: the most complete, then one with a website, then by source key and id."""
    with_site = F.coalesce(F.col("website") != "", F.lit(False))
    return F.struct((-completeness()).alias("a"), (~with_site).cast("int").alias("b"), "source", "source_id", "id")


def keyed(rows: DataFrame) -> DataFrame:
    """rows with their merge key: state, name and city in normal form; the last two columns say what cannot be grouped."""
    name = normalize_name(F.when(F.coalesce(F.col("normalized_name"), F.lit("")) != "", F.col("normalized_name")).otherwise(F.col("name")))
    out = rows.withColumns({"_name": name, "_city": normalize_name("city"), "_state": F.upper(F.trim(F.coalesce("state", F.lit("")))), "_order": canonical_order()})
    return out.withColumn("_groupable", (F.col("_name") != "") & (F.col("_city") != "") & (F.col("_state") != ""))


MERGE_KEY = ["category", "_state", "_name", "_city"]


def plan(rows: DataFrame) -> DataFrame:
    """One row for each group: group_key, size, the canonical row's id, source and source_id, the merged values, and
    conflicts (field to its different values, sorted). All of it combines before the shuffle."""

    def first_present(c: str) -> Column:
        return F.min_by(F.col(c), F.when(present(c), F.col("_order")))

    def values(c: str) -> Column:
        return F.array_sort(F.collect_set(F.when(present(c), F.col(c).cast("string"))))

    found = keyed(rows).where("_groupable").groupBy(*MERGE_KEY).agg(
        F.count("*").alias("size"),
        F.min("_order").alias("_first"),
        *(first_present(c).alias(c) for c in FIELDS if c != "source_year"),
        F.max("source_year").alias("source_year"),
        F.max((F.col("is_active") == 1).cast("int")).alias("is_active"),
        F.map_from_arrays(F.array(*map(F.lit, FIELDS)), F.array(*map(values, FIELDS))).alias("_values"),
    )
    return found.where("size > 1").select(
        F.concat_ws(" | ", "category", "_state", "_name", "_city").alias("group_key"),
        "category",
        "size",
        F.col("_first.id").alias("canonical_id"),
        F.col("_first.source").alias("canonical_source"),
        F.col("_first.source_id").alias("canonical_source_id"),
        "name",
        F.col("_name").alias("normalized_name"),
        "city",
        "state",
        F.coalesce("country", F.lit("US")).alias("country"),
        "website",
        "logo_key",
        "source_year",
        "is_active",
        F.map_filter("_values", lambda k, v: F.size(v) > 1).alias("conflicts"),
    )


def merged_rows(plans: DataFrame) -> DataFrame:
    """What the canonical rows get, by id."""
    return plans.select(F.col("canonical_id").alias("id"), "category", "name", "normalized_name", *FIELDS[1:], "is_active")


def superseded(rows: DataFrame) -> DataFrame:
    """id of the rows that a merge deletes."""
    own = keyed(rows).where("_groupable").select(*MERGE_KEY, "id", "_order")
    first = own.groupBy(*MERGE_KEY).agg(F.min("_order").alias("_first"))
    return own.join(first, MERGE_KEY).where("_order <> _first").select("id")


def conflict_list(plans: DataFrame) -> DataFrame:
    """group_key, field, values (joined by ' | ')."""
    return plans.select("group_key", F.explode("conflicts").alias("field", "v")).select("group_key", "field", F.array_join("v", " | ").alias("values"))


def plan_totals(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """One row: groups, rows, deletions, groups in conflict, and rows that cannot be grouped."""
    some = plans.agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("size") - 1), F.lit(0)).alias("deletions"),
        F.count_if(F.size("conflicts") > 0).alias("conflict_groups"),
    )
    return some.join(keyed(rows).agg(F.count_if(~F.col("_groupable")).alias("ungroupable")), how="full")
