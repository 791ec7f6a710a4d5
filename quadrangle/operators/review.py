"""The table that people review: members of duplicate groups beside what their source files say."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.functions.text import clean, cleaned_or_null, join_parts
from quadrangle.operators.duplicates import report_order
from quadrangle.operators.numbering import numbered

CONTEXT = (
    "rawName", "website", "sourceAddress", "sourceCity", "sourceState", "sourceZip", "mailingAddress", "mailingCity", "mailingState", "mailingZip",
    "districtOrLea", "status", "schoolType", "sourceClassification", "gradeRange", "sourceFrame", "reviewNotes",
)
COLUMNS = (
    "groupId", "candidateType", "groupSize", "dbId", "source", "sourceId", "sourceYear", "category", "name", "normalizedName", "dbCity", "dbState", "dbIsActive",
    *CONTEXT[:16], "sourceMatch", "reviewDecision", "canonicalSourceId", "reviewNotes",
)


def _upper(c: str) -> Column:
    return F.nullif(F.upper(clean(c)), F.lit(""))


def _either(c: str, other: str) -> Column:
    return F.coalesce(cleaned_or_null(c), cleaned_or_null(other))


def _mappings() -> dict[str, tuple[str, dict[str, Column]]]:
    """What each source's columns say: the key's column, and the context columns."""
    own = cleaned_or_null
    return {
        "IPEDS": (
            "UNITID",
            {
                "rawName": own("INSTNM"), "website": own("WEBADDR"), "sourceAddress": own("ADDR"), "sourceCity": own("CITY"), "sourceState": _upper("STABBR"),
                "sourceZip": own("ZIP"), "districtOrLea": own("F1SYSNAM"), "schoolType": own("INSTCAT"), "sourceClassification": join_parts(["CONTROL", "SECTOR"]),
                "status": F.when(clean("CYACTIVE") == "1", "Active").otherwise("Inactive/unknown"),
            },
        ),
        "CCD": (
            "NCESSCH",
            {
                "rawName": own("SCH_NAME"), "website": own("WEBSITE"), "sourceAddress": join_parts(["LSTREET1", "LSTREET2", "LSTREET3"]), "sourceCity": own("LCITY"),
                "sourceState": _upper("LSTATE"), "sourceZip": join_parts(["LZIP", "LZIP4"]), "mailingAddress": join_parts(["MSTREET1", "MSTREET2", "MSTREET3"]),
                "mailingCity": own("MCITY"), "mailingState": _upper("MSTATE"), "mailingZip": join_parts(["MZIP", "MZIP4"]),
                "districtOrLea": join_parts(["LEA_NAME", "LEAID"]), "status": own("SY_STATUS_TEXT"), "schoolType": own("SCH_TYPE_TEXT"),
                "sourceClassification": join_parts(["CHARTER_TEXT", "OUT_OF_STATE_FLAG"]), "gradeRange": join_parts(["GSLO", "GSHI"]),
            },
        ),
        "PSS": (
            "PPIN",
            {
                "rawName": own("PINST"), "sourceAddress": own("PL_ADD"), "sourceCity": _either("PL_CIT", "PCITY"),
                "sourceState": F.coalesce(_upper("PL_STABB"), _upper("PSTABB")), "sourceZip": _either("PL_ZIP", "PZIP"), "mailingAddress": own("PADDRS"),
                "mailingCity": own("PCITY"), "mailingState": _upper("PSTABB"), "mailingZip": own("PZIP"), "districtOrLea": own("PCNTNM"),
                "status": F.lit("PSS respondent record"), "schoolType": own("TYPOLOGY"), "sourceClassification": join_parts(["RELIG", "ORIENT"]),
                "gradeRange": join_parts(["LOGR2024", "HIGR2024"]), "sourceFrame": own("FRAME"),
                "reviewNotes": F.when(clean("PL_CIT") == "", "Physical city unavailable; mailing city shown as fallback.").otherwise(""),
            },
        ),
    }


def context(raw: DataFrame, source: str) -> DataFrame:
    """source, source_id, row_no and the context columns of one source file; columns that the file lacks are null."""
    key, given = _mappings()[source]
    for c in sorted(set(_OPTIONAL[source].split()) - set(raw.columns)):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    columns = [given.get(c, F.lit("" if c == "reviewNotes" else None).cast("string")).alias(c) for c in CONTEXT]
    return raw.select(F.lit(source).alias("source"), clean(key).alias("source_id"), "row_no", *columns)


# Columns that a file may lack.
_OPTIONAL = {
    "IPEDS": "ADDR ZIP F1SYSNAM INSTCAT CONTROL SECTOR",
    "CCD": "LSTREET1 LSTREET2 LSTREET3 LZIP LZIP4 MSTREET1 MSTREET2 MSTREET3 MCITY MSTATE MZIP MZIP4 LEA_NAME LEAID SCH_TYPE_TEXT CHARTER_TEXT OUT_OF_STATE_FLAG GSLO GSHI",
    "PSS": "PL_ADD PL_STABB PSTABB PL_ZIP PZIP PADDRS PCNTNM TYPOLOGY RELIG ORIENT LOGR2024 HIGR2024 FRAME",
}


def contexts(files: dict[str, DataFrame]) -> DataFrame:
    """The union of all files' contexts, by source name."""
    return reduce(DataFrame.unionByName, (context(raw, source) for source, raw in files.items()))


def last_rows(rows: DataFrame, keys: list[str], order: str = "row_no") -> DataFrame:
    """The last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x"))
    return latest.select(*keys, *(F.col(f"x.{c}").alias(c) for c in rest))


def named_groups(found: DataFrame) -> DataFrame:
    """Groups with groupId DUP-0001 and on, in report order."""
    return numbered(found, report_order(), "_n").withColumn("groupId", F.format_string("DUP-%04d", "_n")).drop("_n")


def review_table(members: DataFrame, raw_contexts: DataFrame) -> DataFrame:
    """members (groupId, candidateType, groupSize and the catalog's columns of each group's rows) with the context of their
    last raw row; rows without one say so."""
    found = last_rows(raw_contexts, ["source", "source_id"]).drop("row_no").withColumn("_hit", F.lit(True))
    own = members.select(
        "groupId", F.col("candidate_type").alias("candidateType"), F.col("size").alias("groupSize"), F.col("id").alias("dbId"), "source", "source_id",
        F.col("source_year").alias("sourceYear"), "category", "name", F.col("normalized_name").alias("normalizedName"), F.col("city").alias("dbCity"),
        F.col("state").alias("dbState"), F.col("is_active").alias("dbIsActive"),
    )
    both = own.join(found, ["source", "source_id"], "left").withColumn("sourceId", F.col("source_id"))
    hit = F.col("_hit").isNotNull()
    return both.withColumns(
        {
            "sourceMatch": F.when(hit, "matched_raw_row").otherwise("missing_raw_row"),
            "reviewDecision": F.lit(""),
            "canonicalSourceId": F.lit(""),
            "reviewNotes": F.when(hit, F.coalesce("reviewNotes", F.lit(""))).otherwise("Raw source row was not found."),
        }
    ).select(*COLUMNS)
