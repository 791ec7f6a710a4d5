"""Numbered versions of a table in a folder of a shared file system: `NNNNNNNNNN.json` files that are made exclusively and never changed.

A version is written beside the log first and then gets its number by an operation that fails where the number is taken: a hard link on a
local or mounted file system, a rename elsewhere (of a file system whose rename does not replace files, as the distributed ones do). So of
two writers one gets the number and the other learns it, and a reader finds whole versions only.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Conflict(Exception):
    """The version that a change was made from is no longer the latest."""


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_versions"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:010d}.json"

    def latest(self) -> int:
        """The number of the latest version, 0 if there is none."""
        if not self._fs.exists(self._path(self.folder)):
            return 0
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)))
        return max((int(n[:10]) for n in names if n.endswith(".json") and n[:10].isdigit()), default=0)

    def read(self, number: int) -> dict:
        """A version's content; small: it names files, not rows."""
        return json.loads(self.spark.read.text(self._name(number), wholetext=True).first()[0])

    def append(self, number: int, content: dict) -> None:
        """Makes version `number`, or raises Conflict if it is there already."""
        self._fs.mkdirs(self._path(self.folder))
        draft, text = f"{self.folder}/draft-{uuid.uuid4().hex}", json.dumps(content)
        if self._fs.getScheme() == "file":
            local = [unquote(urlparse(p).path) for p in (draft, self._name(number))]
            with open(local[0], "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(*local)
            except FileExistsError as e:
                raise Conflict(f"version {number} is there already") from e
            finally:
                os.unlink(local[0])
            return
        out = self._fs.create(self._path(draft), False)
        out.write(text.encode())
        out.close()
        if self._fs.exists(self._path(self._name(number))) or not self._fs.rename(self._path(draft), self._path(self._name(number))):
            self._fs.delete(self._path(draft), False)
            raise Conflict(f"version {number} is there already")
