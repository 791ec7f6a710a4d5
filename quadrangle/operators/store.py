"""A table whose writes touch what changes: rows lie in buckets by a hash of the key, a version names the folder of each bucket.

A change is given the rows of the buckets that its keys fall into, and its result replaces these buckets alone: their rows go to new
folders, the others stay where they are. The next version names the new folders and is published only if no other writer was faster
(`VersionLog`). Otherwise the change is made good from the version that is there now: if the other writer touched other buckets the new
folders stand beside theirs, else the change runs again on the new rows. So no update is lost, and since files are never changed or
removed, a reader keeps what it began with.

Reads can be limited to the buckets of some keys. Changes that know rows by another column than the key find the buckets by a scan of that
column and the key alone. What the driver holds is a line for each bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadrangle.operators import upsert as writes
from quadrangle.sources.scratch import written
from quadrangle.sources.versions import Conflict, VersionLog


class Store:
    """A table of a schema under a folder, with rows dealt to buckets by key columns."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.log = spark, folder.rstrip("/"), VersionLog(spark, folder)
        first = self.log.read(1)
        self.schema, self.key, self.buckets = StructType.fromJson(first["schema"]), first["key"], first["buckets"]

    @classmethod
    def create(cls, rows: DataFrame, folder: str, key: list[str], buckets: int) -> Store:
        """A new store that holds rows; a Conflict if the folder has one already."""
        placed = _written_buckets(rows, folder.rstrip("/"), key, buckets)
        VersionLog(rows.sparkSession, folder).append(1, {"schema": rows.schema.jsonValue(), "key": key, "buckets": buckets, "folders": placed})
        return cls(rows.sparkSession, folder)

    def bucket(self) -> Column:
        return _bucket(self.key, self.buckets)

    def version(self) -> int:
        return self.log.latest()

    def read(self, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (the latest), of all buckets or of some."""
        folders = self.log.read(version or self.version())["folders"]
        wanted = folders if only is None else {str(b) for b in only}
        paths = [f"{self.folder}/data/{folders[b]}" for b in folders if b in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def buckets_of(self, keys: DataFrame) -> set[int]:
        """Of rows that have the key columns: a number for each bucket at most."""
        return {r.b for r in keys.select(self.bucket().alias("b")).distinct().collect()}

    def buckets_where(self, rows: DataFrame, on: str, version: int) -> set[int]:
        """The buckets whose rows match rows on a column that is not the key."""
        known = self.read(version).select(on, *(c for c in self.key if c != on))
        return self.buckets_of(known.join(rows.select(on), on, "left_semi"))

    def commit(self, touched: Callable[[int], set[int]], change: Callable[[DataFrame], DataFrame], tries: int = 20) -> int:
        """Applies change to the rows of the touched buckets (of a version) and publishes the result; the new version's number."""
        made = based = None
        for _ in range(tries):
            now = self.version()
            wanted = {str(b) for b in touched(now)}
            folders = self.log.read(now)["folders"]
            # what was made before holds if none of its buckets has changed since
            if made is None or wanted != set(made) or any(folders.get(b) != based.get(b) for b in wanted):
                rows = change(self.read(now, (int(b) for b in wanted))).select(*self.schema.names)
                found = _written_buckets(rows, self.folder, self.key, self.buckets)
                if set(found) - wanted:
                    raise ValueError("a change must not move rows to buckets that it does not touch")
                made, based = {b: found.get(b) for b in wanted}, {b: folders.get(b) for b in wanted}
            merged = {b: f for b, f in (folders | made).items() if f is not None}
            try:
                self.log.append(now + 1, {"folders": merged})
            except Conflict:
                continue
            return now + 1
        raise Conflict(f"no version was free in {tries} tries")


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _written_buckets(rows: DataFrame, folder: str, key: list[str], buckets: int) -> dict[str, str]:
    """Writes rows to a new folder for each of their buckets; the folders' names by bucket."""
    name = uuid.uuid4().hex
    dealt = rows.withColumn("_bucket", _bucket(key, buckets)).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *key)
    dealt.write.partitionBy("_bucket").option("compression", "zstd").parquet(f"{folder}/data/{name}")
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/data/{name}")
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    found = (s.getPath().getName() for s in listed)
    return {n.partition("=")[2]: f"{name}/{n}" for n in found if n.startswith("_bucket=")}


# ---------------------------------------------------------------- the catalog's writes


def upsert(store: Store, incoming: DataFrame, run_ts: Column, preserve_website: bool = False) -> int:
    """Incoming records inserted or put over the row of the same key; see `upsert.upsert`."""
    incoming = written(incoming)
    touched = store.buckets_of(incoming)
    return store.commit(lambda _: touched, lambda rows: writes.upsert(rows, incoming, run_ts, preserve_website))


def fill_blank(store: Store, updates: DataFrame, column: str, run_ts: Column | None = None, on: str = "id") -> int:
    """A column's values (on, column) where it is still blank: of writers that fill the same row the first one wins."""
    updates = written(updates)
    return store.commit(lambda version: store.buckets_where(updates, on, version), lambda rows: writes.fill_blank(rows, updates, [on], column, run_ts))


def apply_merges(store: Store, merged: DataFrame, deleted: DataFrame, run_ts: Column | None = None) -> int:
    """Rows deleted by id, and merged values put into their canonical rows."""
    merged, deleted = written(merged), written(deleted)
    ids = merged.select("id").unionByName(deleted.select("id"))
    return store.commit(lambda version: store.buckets_where(ids, "id", version), lambda rows: writes.apply_merges(rows, merged, deleted, run_ts))
