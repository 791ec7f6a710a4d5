"""Website research: the export of what is missing, and the checked return of what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.functions.text import present, same_as_exported, sql_blank, trimmed
from quadrangle.functions.urls import researched_website
from quadrangle.sources.reports import with_batches
from quadrangle.sources.scratch import measured

# Outcomes, and below the texts that go with them.
STRUCTURAL = ("duplicate_or_blank_id", "unknown_local_id", "modified_reference_fields")
REFERENCE = ("name", "category", "city", "state", "country")


def missing_websites(institutions: DataFrame, batch_size: int = 100) -> DataFrame:
    """What is exported for research, with the number of its batch."""
    rows = institutions.where(sql_blank("website"))
    order = ["category", "state", "normalized_name", "city", "source", "source_id"]
    return with_batches(rows, order, batch_size).select("batch", "id", *REFERENCE, F.coalesce("website", F.lit("")).alias("website"))


def first_outcomes(records: DataFrame) -> DataFrame:
    """records (file_name, row_number, id, the reference fields, website) with the checked website and a first outcome:
    invalid_website, pending, or unresolved where nothing was found."""
    checked = records.withColumn("_w", researched_website("website")).withColumn("id", trimmed("id"))
    outcome = F.when(F.col("_w.detail").isNotNull(), "invalid_website").when(F.col("_w.website").isNotNull(), "pending").otherwise("unresolved")
    return checked.select(
        *(c for c in records.columns if c != "website"), F.col("website").alias("submitted_website"), F.col("_w.website").alias("website"),
        outcome.alias("outcome"), F.col("_w.detail").alias("detail"),
    )


def with_structure(records: DataFrame, institutions: DataFrame) -> DataFrame:
    """records after the structural checks, with what the catalog knows of their ids (_known, _website, source, source_id).
    A later check overwrites an earlier one's outcome. Rows of a blank id are spread, so that they need not meet."""
    key = F.struct("id", F.when(F.col("id") == "", F.xxhash64("file_name", "row_number")).alias("n"))
    counted = records.withColumn("_copies", F.count("*").over(Window.partitionBy(key)))
    names = ["source", "source_id", "website", *REFERENCE]
    known = institutions.select("id", F.struct(*names).alias("_i"))
    both = counted.join(known, "id", "left")
    same = F.lit(True)
    for c in REFERENCE:
        same = same & same_as_exported(c, f"_i.{c}")
    unknown, repeated = F.col("_i").isNull(), (F.col("id") == "") | (F.col("_copies") > 1)
    outcome = F.when(unknown, "unknown_local_id").when(~same, "modified_reference_fields").when(repeated, "duplicate_or_blank_id").otherwise(F.col("outcome"))
    detail = (
        F.when(unknown, "No matching local D1 institution was found.")
        .when(~same, "Only website may differ from the exported CSV.")
        .when(repeated, "Each CSV row must have one unique nonblank id.")
        .otherwise(F.col("detail"))
    )
    return both.select(
        *(c for c in records.columns if c not in ("outcome", "detail")), outcome.alias("outcome"), detail.alias("detail"),
        F.col("_i.source").alias("source"), F.col("_i.source_id").alias("source_id"), F.col("_i.website").alias("_website"), F.col("_i").isNotNull().alias("_known"),
    )


def local_outcomes(checked: DataFrame) -> DataFrame:
    """Pending rows against the catalog itself."""
    pending, same = F.col("outcome") == "pending", F.col("_website") == F.col("website")
    found = present("_website")
    outcome = F.when(pending & found & same, "already_current_local").when(pending & found, "local_website_conflict").when(pending, "would_update_local")
    detail = F.when(pending & found & same, "Local D1 already has this website.").when(pending & found, "Local D1 already has a different nonblank website.")
    return _finished(checked, outcome, detail, pending)


def remote_outcomes(checked: DataFrame, remote: DataFrame) -> DataFrame:
    """Pending rows against a second catalog, met by source key; the first one must have the website already."""
    there = remote.select("source", "source_id", F.col("website").alias("_remote"), F.lit(True).alias("_there"))
    both = checked.join(there, ["source", "source_id"], "left")
    pending = F.col("outcome") == "pending"
    steps: list[tuple[Column, str, str | None]] = [
        (~F.coalesce(F.col("_website") == F.col("website"), F.lit(False)), "local_not_synced", "Run the local --apply step before remote synchronization."),
        (F.col("_there").isNull(), "remote_id_not_found", "No matching remote D1 institution was found."),
        (~present("_remote"), "would_update_remote", None),
        (F.col("_remote") == F.col("website"), "already_current_remote", "Remote D1 already has this website."),
        (F.lit(True), "remote_website_conflict", "Remote D1 already has a different nonblank website."),
    ]
    outcome = detail = None
    for when, name, text in steps:
        outcome = F.when(pending & when, name) if outcome is None else outcome.when(pending & when, name)
        detail = F.when(pending & when, F.lit(text)) if detail is None else detail.when(pending & when, F.lit(text))
    return _finished(both, outcome, detail, pending)


def _finished(rows: DataFrame, outcome: Column, detail: Column, pending: Column) -> DataFrame:
    values = {"outcome": F.coalesce(outcome, F.col("outcome")), "detail": F.when(pending, detail).otherwise(F.col("detail"))}
    return rows.withColumns(values).drop("_website", "_known", "_remote", "_there")


def updates(outcomes: DataFrame, target: str = "local") -> DataFrame:
    """id, source, source_id, website of the rows that may be applied."""
    return outcomes.where(F.col("outcome") == f"would_update_{target}").select("id", "source", "source_id", "website")


def applied(outcomes: DataFrame, target: str = "local") -> DataFrame:
    """The report after the updates were applied."""
    return outcomes.withColumn("outcome", F.when(F.col("outcome") == f"would_update_{target}", f"updated_{target}").otherwise(F.col("outcome")))


def reconcile(records: DataFrame, institutions: DataFrame, remote: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """(outcomes, whether they may be applied). With a structural problem nothing of the batch may be applied and all other rows keep their
    first outcome. The job that writes the checked rows counts the problems, so the batch is read and checked once."""
    checked, seen = measured(with_structure(first_outcomes(records), institutions), F.count_if(F.col("outcome").isin(*STRUCTURAL)).alias("problems"))
    if seen["problems"]:
        return checked.drop("_website", "_known"), False
    return (local_outcomes(checked) if remote is None else remote_outcomes(checked, remote)), True


def histogram(rows: DataFrame, column: str = "outcome") -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("rows")).orderBy(column)
