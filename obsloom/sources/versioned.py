"""Small tables that a job reads and rewrites.

Each rewrite, and each append, goes to a new ``version=N`` folder. A version counts once its write has
been committed, which the ``_SUCCESS`` file shows: what a failed write left behind is never read, and
its number is not used again. A number is reserved by creating a file that only one writer can create, so of
two jobs that take the same number the second fails, before it has written anything, and can be repeated. Versions are kept for a day for jobs that still read them.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from obsloom.sources.files import aligned, read_parquet
from obsloom.sources.storage import CommitLog

KEPT_SECONDS = 24 * 3600


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self.claims = CommitLog(spark, f"{path}/_claims")

    def _folders(self) -> dict[int, float | None]:
        """The version folders with the time of their commit in seconds, None without one."""
        system, folder = self._at(self.path)
        if not system.exists(folder):
            return {}
        out = {}
        for status in system.listStatus(folder):
            if m := re.fullmatch(r"version=(\d+)", status.getPath().getName()):
                _, mark = self._at(f"{self.path}/version={m.group(1)}/_SUCCESS")
                out[int(m.group(1))] = system.getFileStatus(mark).getModificationTime() / 1000 if system.exists(mark) else None
        return out

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(v for v, done in self._folders().items() if done is not None)

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def read(self) -> DataFrame:
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return read_parquet(self.spark, f"{self.path}/version={version}", self.schema)

    def replace(self, df: DataFrame) -> None:
        """Store ``df`` as the next version and let go of versions replaced long ago."""
        folders = self._folders()
        number = max(max(folders, default=0), self.claims.newest()) + 1
        if not self.claims.add(number, {}):
            raise FileExistsError(f"another job writes version {number} of {self.path}")
        aligned(df, self.schema).write.mode("error").parquet(f"{self.path}/version={number}")
        committed = sorted((v, done) for v, done in folders.items() if done is not None)
        for (old, _), (_, replaced) in zip(committed, committed[1:]):
            if replaced < time.time() - KEPT_SECONDS:
                system, folder = self._at(f"{self.path}/version={old}")
                system.delete(folder, True)

    def _at(self, path: str):
        """The file system of ``path`` and the path in its terms."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder

    def append(self, df: DataFrame) -> None:
        """Store the newest version with more rows as the next one."""
        self.replace(self.read().unionByName(aligned(df, self.schema)))

    def ensure(self) -> None:
        """Create the table, empty, if it is absent."""
        if self.version() is None:
            self.replace(self.spark.createDataFrame([], self.schema))
