"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where the session names none, a temporary folder on a local master, as in tests; an error on a cluster, whose
    machines would each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("quadrangle.scratch.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quadrangle-")
        spark.conf.set("quadrangle.scratch.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/quadrangle/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """rows as a table that is computed once: cuts the lineage, and lost executors do not bring it back."""
    path = new_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def measured(rows: DataFrame, *aggregates: Column) -> tuple[DataFrame, dict]:
    """rows as a table, and aggregates over them (each with a name) that the job which writes the table finds on its way."""
    seen = Observation()
    out = written(rows.observe(seen, *aggregates))
    return out, seen.get


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of spark.sql for the tables that are written meanwhile; their names have __ for each dot."""
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
