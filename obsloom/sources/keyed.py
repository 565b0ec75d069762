"""Tables of one row per key that grow by small changes.

A change is a folder of rows and a numbered record that names it; nothing that is stored is rewritten.
Reading takes the newest row of every key. After ``fan_in`` changes the writer stores that state as a
snapshot, and readers start from it, so a read opens a bounded number of folders. Changes commute
with other writers' changes: one that finds its number taken takes the next, and no writer waits or loses rows.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsloom.sources.files import aligned, read_parquet
from obsloom.sources.storage import CommitLog

KEPT_SECONDS = 24 * 3600


class KeyedLog:
    """``newest`` names the column whose greatest value wins; without it the latest change does."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], newest: str | None = None, fan_in: int = 16):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        self.order, self.fan_in = [*([newest] if newest else []), "_change"], fan_in
        self.changes, self.snapshots = CommitLog(spark, f"{path}/_changes"), CommitLog(spark, f"{path}/_snapshots")

    def version(self) -> int | None:
        """Number of the latest change; None before the first."""
        return max(self.changes.newest(), self.snapshots.newest()) or None

    def folders(self, upto: int | None = None) -> list[tuple[int, str]]:
        """What a read opens: the newest snapshot and the changes after it, each with its number."""
        snapshots = [n for n in self.snapshots.numbers() if upto is None or n <= upto]
        found = [(snapshots[-1], self.snapshots.read(snapshots[-1])["folder"])] if snapshots else []
        for n in self.changes.numbers():
            if (not found or n > found[0][0]) and (upto is None or n <= upto):
                record = self.changes.read(n)
                found = [(n, record["folder"])] if record.get("whole") else [*found, (n, record["folder"])]
        return found

    def read(self, upto: int | None = None) -> DataFrame:
        folders = self.folders(upto)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        parts = [read_parquet(self.spark, f"{self.path}/{f}", self.schema).withColumn("_change", F.lit(n)) for n, f in folders]
        rest = [F.desc(c) for c in self.schema.names if c not in (*self.keys, *self.order)]
        latest = Window.partitionBy(*self.keys).orderBy(*[F.desc(c) for c in self.order], *rest)
        ranked = reduce(DataFrame.unionByName, parts).withColumn("_rank", F.row_number().over(latest))
        return ranked.where("_rank = 1").select(*self.schema.names)

    def append(self, rows: DataFrame) -> None:
        """Add rows, or newer ones for keys that are there."""
        number = self.changes.append({"folder": self._written(rows)})
        if len(self.folders(number)) > self.fan_in:
            self.compact(number)

    def replace(self, rows: DataFrame) -> None:
        """Store ``rows`` in place of all that was there before."""
        self.changes.append({"folder": self._written(rows), "whole": True})

    def ensure(self) -> None:
        """Create the table, empty, if it is absent."""
        if self.version() is None:
            self.append(self.spark.createDataFrame([], self.schema))

    def compact(self, upto: int) -> None:
        """Store the state up to a change as a snapshot, and let go of what older readers no longer need."""
        self.snapshots.add(upto, {"folder": self._written(self.read(upto))})
        old = [n for n in self.snapshots.numbers() if self.snapshots.written(n) < time.time() - KEPT_SECONDS]
        if old:
            # The last change stays, for the next number to follow it.
            for log, unused in ((self.changes, [n for n in self.changes.numbers()[:-1] if n <= old[-1]]), (self.snapshots, old[:-1])):
                for n in unused:
                    log.storage.delete(f"{self.path}/{log.read(n)['folder']}")
                    log.remove(n)

    def _written(self, rows: DataFrame) -> str:
        folder = f"rows-{uuid.uuid4().hex}"
        aligned(rows, self.schema).write.mode("error").parquet(f"{self.path}/{folder}")
        return folder
