"""Readers of CSV, JSON and table inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadrangle.functions.text import present
from quadrangle.sources import schema
from quadrangle.sources.scratch import written

BOM = chr(0xFEFF)


class InputError(ValueError):
    """An input file does not have the form that it must have."""


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """All columns as text, with `row_no` (from 1, in file order). Header names are trimmed; all missing required columns are
    named at once; a row with another number of fields than the header fails the read; quotes are doubled to escape them;
    fields can hold line breaks; blank lines are skipped.

    row_no is dense within a file of one partition, which multi-line CSV always is; it only grows over several files."""
    rows = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', mode="FAILFAST", enforceSchema=False)
    rows = rows.toDF(*(c.lstrip(BOM).strip() for c in rows.columns))
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise InputError(f"{path}: required columns are missing: {', '.join(missing)}")
    return rows.withColumn("row_no", F.monotonically_increasing_id() + 1)


def read_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The file of a source: IPEDS, CCD or PSS."""
    return read_csv(spark, path, schema.REQUIRED[source])


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """The folder's CSV files by name, through the file system that the path names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(str(s.getPath()) for s in listed if s.isFile() and s.getPath().getName().lower().endswith(".csv"))


def read_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all CSV files of a folder with file_name and row_number (the header is row 1); rows of blanks alone are left out. Every
    header must be the exported one, in its order; a row with another number of fields fails the read.

    One scan reads all files, their headers as rows, and is written down with numbers that grow within a file, which is never split. One
    aggregate over it gives each file's first record, which is its header, and the number that its rows count from."""
    names = schema.ENRICHMENT
    listed = {name.rsplit("/", 1)[-1] for name in csv_files(spark, folder)}
    if not listed:
        raise InputError(f"{folder}: there is no CSV file")
    fields = ", ".join(f"`{c}` string" for c in (*names, "_damaged"))
    read = spark.read.schema(fields).option("pathGlobFilter", "*.[cC][sS][vV]").option("columnNameOfCorruptRecord", "_damaged")
    rows = read.csv(folder, header=False, multiLine=True, escape='"', mode="PERMISSIVE")
    rows = written(rows.select("*", F.col("_metadata.file_name").alias("file_name"), F.monotonically_increasing_id().alias("_at")))
    first = F.min_by(F.struct(*names, "_damaged"), "_at")
    files = written(rows.groupBy("file_name").agg(F.min("_at").alias("_from"), first.alias("header"), F.min(F.when(F.col("_damaged").isNotNull(), F.col("_at"))).alias("_bad")))
    header = [F.trim(F.regexp_replace(F.coalesce(F.col(f"header.{c}"), F.lit("")), f"^{BOM}", "")) == c for c in names]
    right = F.col("header._damaged").isNull()
    for same in header:
        right = right & same
    known = files.select("file_name", right.alias("right"), (F.col("_bad") - F.col("_from") + 1).alias("bad")).where("not right or bad is not null").orderBy("file_name").limit(20).collect()
    missing = sorted(listed - {r.file_name for r in files.select("file_name").collect()})  # files without any record
    wrong = [*(r.file_name for r in known if not r.right), *missing]
    if wrong:
        raise InputError(f"{folder}/{', '.join(wrong)}: the header must be {','.join(names)}")
    if known:
        raise InputError(f"{folder}/{known[0].file_name}: row {known[0].bad} has another number of fields than the header")
    numbered = rows.join(files.select("file_name", "_from"), "file_name").withColumn("row_number", F.col("_at") - F.col("_from") + 1).where("row_number > 1")
    some = F.exists(F.array(*(present(c) for c in names)), lambda x: x)
    return numbered.select("file_name", "row_number", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in names)).where(some)


def read_report(spark: SparkSession, path: str, field: str = "exactLocationCandidates") -> DataFrame:
    """The groups of an audit report in JSON."""
    return spark.read.json(path, multiLine=True).select(F.explode(field).alias("g")).select("g.*")


def read_json_lines(spark: SparkSession, path: str, rows: StructType | str) -> DataFrame:
    return spark.read.schema(rows).json(path)


def read_institutions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.INSTITUTIONS).parquet(path)


def audit_order(institutions: DataFrame) -> DataFrame:
    """The rows as the audits read them."""
    return institutions.orderBy("category", "state", "normalized_name", "city", "source", "source_id")


def lookup(institutions: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is among keys; Spark picks the join."""
    return institutions.join(keys.select(*on).distinct(), on, "left_semi")


def with_columns_of(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows in the layout of names: columns that an older file lacks are empty texts."""
    return rows.select(*(F.col(c) if c in rows.columns else F.lit("").alias(c) for c in names))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_manifest(spark: SparkSession, path: str, legacy: str | None = None, names: tuple[str, ...] = schema.MANIFEST) -> DataFrame:
    """The manifest of evaluated candidates; no rows if there is none. An older review file stands in for a missing manifest if
    all its rows name their institution. Categories other than college are high_school."""
    if exists(spark, path):
        rows = read_csv(spark, path)
    elif legacy and exists(spark, legacy):
        rows = read_csv(spark, legacy)
        if "institution_id" not in rows.columns or rows.where(F.coalesce(F.trim("institution_id"), F.lit("")) == "").take(1):
            rows = rows.limit(0)
    else:
        rows = spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    rows = with_columns_of(rows, list(names))
    if "category" not in names:
        return rows
    return rows.withColumn("category", F.when(F.col("category") == "college", "college").otherwise("high_school"))
