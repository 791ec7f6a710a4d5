"""Validating ingest of the three source files: reasons for rejection, catalog records and import statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.functions import text as T
from quadrangle.functions.urls import imported_website


@dataclass(frozen=True)
class Source:
    """What differs between the sources."""

    name: str
    category: str
    year: int
    id_column: str
    numeric_id: bool
    name_column: str


IPEDS = Source("IPEDS", "college", 2025, "UNITID", True, "INSTNM")
CCD = Source("CCD", "high_school", 2025, "NCESSCH", True, "SCH_NAME")
PSS = Source("PSS", "high_school", 2024, "PPIN", False, "PINST")
SOURCES = {s.name: s for s in (IPEDS, CCD, PSS)}

# Fixed values of the source files.
OPEN_STATUSES = ("Open", "New", "Added", "Reopened", "Changed Boundary/Agency")
PUBLIC_GRADES = ("G_9_OFFERED", "G_10_OFFERED", "G_11_OFFERED", "G_12_OFFERED")
PRIVATE_GRADES = ("P265", "P275", "P285", "P295")


def first_occurrence(key: Column, order: list[Column | str]) -> Column:
    """True on the first row of each key that is not null; later rows of a key are False, and so are null keys."""
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return key.isNotNull() & (number == 1)


def reasons(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules that a row breaks, in the order of the rules."""
    return F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules)))


def any_equals(columns: tuple[str, ...], value: str) -> Column:
    return F.exists(F.array(*(T.clean(c) for c in columns)), lambda x: x == value)


def _rules(source: Source) -> list[tuple[str, Column]]:
    """Named conditions on staged rows (source_id, name, state, duplicate and the raw columns), but for the id's."""
    if source is IPEDS:
        own = [
            ("not_postsecondary", T.clean("POSTSEC") != "1"),
            ("inactive", T.clean("CYACTIVE") != "1"),
            ("outside_50_states_plus_dc", ~F.col("_state").isin(*T.STATES, "DC")),
        ]
    elif source is CCD:
        own = [
            ("inactive_or_noncurrent_status", ~T.clean("SY_STATUS_TEXT").isin(*OPEN_STATUSES)),
            ("outside_50_states", ~F.col("_state").isin(*T.STATES)),
            ("no_grade_9_to_12_offered", ~any_equals(PUBLIC_GRADES, "Yes")),
        ]
    else:
        own = [
            ("outside_50_states_or_invalid_physical_state", F.col("_state").isNull()),
            ("no_grade_9_to_12_offered", ~any_equals(PRIVATE_GRADES, "1")),
        ]
    return [("missing_name", F.col("_name") == ""), *own]


def _state(source: Source) -> Column:
    if source is PSS:
        return T.state_from_code("PSTANSI")
    return F.upper(T.clean("STABBR" if source is IPEDS else "LSTATE"))


def stage(raw: DataFrame, source: Source) -> DataFrame:
    """raw (with row_no) with source_id, reasons, and the record's fields. A rejected row still uses up its source id."""
    source_id = T.cleaned_or_null(source.id_column)
    rows = raw.withColumns({"source_id": source_id, "_name": T.clean(source.name_column), "_state": _state(source)})
    # The first row of each id comes from a combining minimum, so an id of very many rows is one row before it is shuffled; its rows meet
    # that one in a join that Spark can split. A row without an id is no duplicate, whatever it meets.
    first = rows.where(F.col("source_id").isNotNull()).groupBy(F.col("source_id").alias("_id")).agg(F.min("row_no").alias("_first"))
    key = F.coalesce("source_id", F.xxhash64("row_no").cast("string"))  # rows without an id are spread
    rows = rows.join(first, key == F.col("_id"), "left")
    rows = rows.withColumn("_duplicate", F.coalesce(F.col("source_id").isNotNull() & (F.col("row_no") > F.col("_first")), F.lit(False))).drop("_id", "_first")
    id_rules = [("missing_source_id", F.col("source_id").isNull())]
    if source.numeric_id:
        id_rules.append(("invalid_source_id", ~F.col("source_id").rlike("^[0-9]*[1-9][0-9]*$")))
    rows = rows.withColumn("reasons", reasons([*id_rules, *_rules(source), ("duplicate_source_id", F.col("_duplicate"))]))
    physical = T.clean({"IPEDS": "CITY", "CCD": "LCITY", "PSS": "PL_CIT"}[source.name])
    mailing = T.clean("PCITY") if source is PSS else F.lit("")
    site = T.clean({"IPEDS": "WEBADDR", "CCD": "WEBSITE"}[source.name]) if source is not PSS else F.lit("")
    return rows.withColumns(
        {
            "city": F.nullif(F.when(physical != "", physical).otherwise(mailing), F.lit("")),
            "mailing_fallback": (physical == "") & (mailing != ""),
            "given_website": F.nullif(site, F.lit("")),
        }
    )


def accepted(staged: DataFrame, source: Source, run_ts: Column, year: int | None = None) -> DataFrame:
    """Catalog records of the rows without a reason, and invalid_website and mailing_fallback for the statistics."""
    rows = staged.where(F.size("reasons") == 0)
    website = imported_website(F.col("given_website")) if source is not PSS else F.lit(None).cast("string")
    return rows.select(
        T.stable_id(F.lit(source.name), F.col("source_id")).alias("id"),
        F.lit(source.name).alias("source"),
        "source_id",
        F.col("_name").alias("name"),
        T.normalize_name("_name").alias("normalized_name"),
        F.lit(source.category).alias("category"),
        "city",
        F.col("_state").alias("state"),
        F.lit("US").alias("country"),
        website.alias("website"),
        F.lit(None).cast("string").alias("logo_key"),
        F.lit(year or source.year).alias("source_year"),
        F.lit(1).alias("is_active"),
        run_ts.alias("imported_at"),
        (F.col("given_website").isNotNull() & website.isNull()).alias("invalid_website"),
        "mailing_fallback",
    )


def rejected(staged: DataFrame) -> DataFrame:
    return staged.where(F.size("reasons") > 0).select("row_no", "source_id", "reasons")


def reject_histogram(rejects: DataFrame) -> DataFrame:
    """reason, rows: a row counts for each of its reasons."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def histogram_lines(histogram: DataFrame) -> DataFrame:
    """The histogram as the summary prints it: in the order of the text 'reason,rows'."""
    return histogram.withColumn("line", F.concat_ws(",", "reason", F.col("rows").cast("string"))).orderBy("line")


def reject_examples(rejects: DataFrame, order: list[Column | str] | None = None, n: int = 10) -> DataFrame:
    """The first n rejected rows in input order (a top-n, not a full sort)."""
    return rejects.orderBy(*(order or ["row_no"])).limit(n)


def statistics(staged: DataFrame, records: DataFrame) -> DataFrame:
    """One row of counters."""
    every = staged.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.size("reasons") > 0).alias("rejected_rows"),
        F.count_if(F.array_contains("reasons", "duplicate_source_id")).alias("duplicate_source_ids"),
    )
    some = records.agg(
        F.count("*").alias("selected_rows"),
        F.count_if("invalid_website").alias("invalid_websites"),
        F.count_if("mailing_fallback").alias("mailing_city_fallbacks"),
    )
    return every.join(some, how="full")  # one row each


def source_url(source: Source, year: int | None = None) -> str:
    if source is IPEDS:
        return f"https://nces.ed.gov/ipeds/datacenter/data/HD{year or source.year}.zip"
    return "https://nces.ed.gov/ccd/psu_rev.asp" if source is CCD else "https://nces.ed.gov/surveys/pss/pssdata.asp"
