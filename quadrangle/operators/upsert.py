"""Keyed writes as expressions: each returns the rows as they are after the write. `store` applies them to the touched buckets of a table
alone; `publish` writes a whole table's next snapshot beside the old one."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.functions.text import sql_blank
from quadrangle.sources.schema import INSTITUTIONS
from quadrangle.sources.versions import Conflict, VersionLog

KEY = ["source", "source_id"]
#: What an import leaves alone in a row that is there already.
KEPT = ("id", "logo_key", "created_at")


def upsert(target: DataFrame, incoming: DataFrame, run_ts: Column, preserve_website: bool = False) -> DataFrame:
    """target with incoming records inserted, or put over the row of the same key but for KEPT. A null website in incoming
    blanks the stored one, as an import does, unless preserve_website. incoming has one row for each key."""
    new = incoming.select(*KEY, *(F.col(c).alias(f"n_{c}") for c in incoming.columns if c not in KEY), F.lit(True).alias("n_"))
    both = target.withColumn("t_", F.lit(True)).join(new, KEY, "full")
    there, given = F.col("t_").isNotNull(), F.col("n_").isNotNull()
    out = []
    for f in INSTITUTIONS.fields:
        c, n = F.col(f.name), F.col(f"n_{f.name}") if f"n_{f.name}" in new.columns else F.lit(None)
        if f.name in KEY:
            value = c
        elif f.name in ("created_at", "updated_at"):
            changed = given if f.name == "updated_at" else given & ~there
            value = F.when(changed, run_ts).otherwise(c)
        elif f.name in KEPT:
            value = F.when(there, c).otherwise(n)
        elif f.name == "website" and preserve_website:
            value = F.when(given, F.coalesce(n, c)).otherwise(c)
        else:
            value = F.when(given, n).otherwise(c)
        out.append(value.cast(f.dataType).alias(f.name))
    return both.select(*out)


def preview(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """inserted, updated: what an import would do."""
    known = target.select(*KEY, F.lit(True).alias("t_"))
    return incoming.select(*KEY).join(known, KEY, "left").agg(F.count_if(F.col("t_").isNull()).alias("inserted"), F.count_if(F.col("t_").isNotNull()).alias("updated"))


def fill_blank(target: DataFrame, updates: DataFrame, keys: list[str], column: str, run_ts: Column | None = None) -> DataFrame:
    """target with `column` taken from updates (keys, column) where it is still blank; run_ts, if given, goes to updated_at of
    the rows that change."""
    new = updates.select(*keys, F.col(column).alias("n_"))
    both = target.join(new, keys, "left")
    changes = F.col("n_").isNotNull() & sql_blank(column)
    values = {column: F.when(changes, F.col("n_")).otherwise(F.col(column))}
    if run_ts is not None:
        values["updated_at"] = F.when(changes, run_ts).otherwise(F.col("updated_at"))
    return both.withColumns(values).select(*target.columns)


def apply_merges(target: DataFrame, merged: DataFrame, deleted: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """target without the rows whose id is in deleted, and with the merged values in the canonical rows (by id)."""
    fields = [c for c in merged.columns if c in target.columns and c != "id"]
    new = merged.select("id", F.struct(*fields).alias("m_"))
    rest = target.join(deleted.select("id"), "id", "left_anti").join(new, "id", "left")
    values = {c: F.when(F.col("m_").isNotNull(), F.col(f"m_.{c}")).otherwise(F.col(c)) for c in fields}
    if run_ts is not None and "updated_at" in target.columns:
        values["updated_at"] = F.when(F.col("m_").isNotNull(), run_ts).otherwise(F.col("updated_at"))
    return rest.withColumns(values).select(*target.columns)


def import_log(records: DataFrame, url: str, file_name: str, run_ts: Column) -> DataFrame:
    """The row that a finished import adds to the log, one for each source and year in records."""
    return records.groupBy("source", "source_year").agg(F.count("*").alias("row_count")).select(
        "source", "source_year", F.lit(url).alias("source_url"), F.lit(file_name).alias("file_name"), "row_count", F.lit("completed").alias("status"), run_ts.alias("imported_at")
    )


def publish(snapshot: DataFrame, folder: str, based_on: int | None = None) -> int:
    """Writes a snapshot under the folder, sorted so that lookups by name skip row groups, and then makes it the next version; readers see
    the old one until then, and a failed write changes nothing. With based_on, the version that the snapshot was made from, a Conflict
    if there is a later one by now; without it the snapshot takes the next free number. Writers of parts of a table use `store`."""
    name = f"snapshot-{uuid.uuid4().hex}"
    by_name = snapshot.repartitionByRange("category", "normalized_name").sortWithinPartitions("category", "normalized_name")
    by_name.write.parquet(f"{folder}/{name}")
    log = VersionLog(snapshot.sparkSession, folder)
    while True:
        number = (log.latest() if based_on is None else based_on) + 1
        try:
            log.append(number, {"snapshot": name})
            return number
        except Conflict:
            if based_on is not None:
                raise


def current(spark: SparkSession, folder: str) -> DataFrame:
    log = VersionLog(spark, folder)
    return spark.read.parquet(f"{folder}/{log.read(log.latest())['snapshot']}")
