"""Schemas of the catalog's tables and of its input files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

INSTITUTIONS = StructType(
    [
        StructField("id", StringType(), False),
        StructField("source", StringType(), False),
        StructField("source_id", StringType(), False),
        StructField("name", StringType(), False),
        StructField("normalized_name", StringType(), False),
        StructField("category", StringType(), False),
        StructField("city", StringType()),
        StructField("state", StringType()),
        StructField("country", StringType(), False),
        StructField("website", StringType()),
        StructField("logo_key", StringType()),
        StructField("source_year", IntegerType()),
        StructField("is_active", IntegerType(), False),
        StructField("created_at", TimestampType(), False),
        StructField("imported_at", TimestampType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
)
TECHNOLOGIES = StructType(
    [
        StructField("id", StringType(), False),
        StructField("name", StringType(), False),
        StructField("normalized_name", StringType(), False),
        StructField("category", StringType(), False),
        StructField("website", StringType()),
        StructField("logo_key", StringType()),
        StructField("created_at", TimestampType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
)
ALIASES = StructType(
    [
        StructField("entity_type", StringType(), False),
        StructField("entity_id", StringType(), False),
        StructField("alias", StringType(), False),
        StructField("normalized_alias", StringType(), False),
    ]
)
IMPORT_BATCHES = StructType(
    [
        StructField("source", StringType(), False),
        StructField("source_year", IntegerType()),
        StructField("source_url", StringType()),
        StructField("file_name", StringType()),
        StructField("row_count", LongType(), False),
        StructField("status", StringType(), False),
        StructField("imported_at", TimestampType(), False),
    ]
)
CATEGORIES = ("college", "high_school")
TECHNOLOGY_CATEGORIES = ("language", "framework", "technology")
BATCH_STATUSES = ("running", "dry_run", "completed", "failed")

# Columns that the input files must have.
REQUIRED = {
    "IPEDS": ("UNITID", "INSTNM", "CITY", "STABBR", "WEBADDR", "POSTSEC", "CYACTIVE"),
    "CCD": ("NCESSCH", "SCH_NAME", "LCITY", "LSTATE", "WEBSITE", "SY_STATUS_TEXT", "G_9_OFFERED", "G_10_OFFERED", "G_11_OFFERED", "G_12_OFFERED"),
    "PSS": ("PPIN", "PINST", "PCITY", "PSTANSI", "PL_CIT", "P265", "P275", "P285", "P295"),
}
ENRICHMENT = ("id", "name", "category", "city", "state", "country", "website")

# Columns of the manifest of evaluated candidates, of its compact review, and of the retrieval table.
# fmt: off
MANIFEST = (
    "institution_id", "run_seed", "institution_name", "normalized_name", "category", "city", "state", "website", "source_page_url", "candidate_url",
    "preview_path", "candidate_rank", "score", "auto_selected", "status", "content_type", "source_bytes", "preview_bytes", "width", "height", "reasons",
    "candidate_metadata", "candidate_ancestry", "candidate_region", "ai_choice", "ai_confidence", "ai_reason", "ai_model", "ai_status", "ai_duration_ms",
    "ai_kind", "ai_eligible", "error",
)
REVIEW = (
    "institution_name", "category", "website", "candidate_rank", "score", "auto_selected", "ai_kind", "ai_eligible", "ai_choice", "ai_confidence",
    "ai_status", "candidate_url", "error", "status",
)
RETRIEVAL = (
    "institution_id", "run_seed", "institution_name", "category", "website", "inventory_index", "batch_number", "source", "candidate_url",
    "source_page_url", "page_region", "metadata", "ancestry", "batch_rank", "final_rank", "status", "error",
)
# fmt: on


def _checked(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return rows.withColumn("violations", broken).where(F.size("violations") > 0)


def violations(institutions: DataFrame) -> DataFrame:
    """Rows that break a constraint of the institutions table, with a list of those broken; keys are checked by
    operators.duplicates.source_key_collisions."""
    needed = [f.name for f in INSTITUTIONS.fields if not f.nullable]
    rules = {f"{c} is missing": F.col(c).isNotNull() for c in needed}
    return _checked(institutions, rules | {"category": F.col("category").isin(*CATEGORIES), "is_active": F.col("is_active").isin(0, 1)})


def batch_violations(batches: DataFrame) -> DataFrame:
    return _checked(batches, {"row_count": F.col("row_count") >= 0, "status": F.col("status").isin(*BATCH_STATUSES)})
