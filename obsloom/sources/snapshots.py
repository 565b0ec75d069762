"""Tables of repeated full copies, such as a daily download of a whole list, stored by copy.

Each copy (the rows with one value of ``column``) has folders of its own, which a manifest names. So the newest copy is
known from the manifest and read alone, however many older ones are kept, and appending a copy writes that copy
alone. A manifest is one file that only one writer can create: appends commute and take the next number, and a rewrite
fails if another job was committed since it began. Old manifests, and folders that none names, go after a day.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsloom.operators.snapshot import latest_snapshot
from obsloom.sources.files import aligned, read_parquet
from obsloom.sources.storage import CommitLog, Storage

KEPT_SECONDS = 24 * 3600
COPY = "copy"
#: Under this name Spark stores the rows without a value, or with an empty one.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class SnapshotTable:
    """``column`` is a text; greater texts are newer copies."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, column: str):
        self.spark, self.path, self.schema, self.column = spark, path, schema, column
        self.manifests = CommitLog(spark, f"{path}/_manifests")
        self.storage = Storage(spark)

    def version(self) -> int | None:
        """The newest committed manifest; None before the first."""
        return self.manifests.newest() or None

    def _parts(self, number: int | None) -> dict[str, list[str]]:
        """The folders of each copy."""
        return self.manifests.read(number)["parts"] if number else {}

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if len(paths) > 1 else read_parquet(self.spark, paths[0], self.schema)

    def copies(self) -> list[str]:
        """The stored copies, oldest first."""
        return sorted(v for v in self._parts(self.version()) if v != NO_VALUE)

    def read(self) -> DataFrame:
        parts = self._parts(self.version())
        return self._rows([f for value in sorted(parts) for f in parts[value]])

    def newest(self) -> DataFrame:
        """The rows of the newest copy, from its folders alone; rows without a value only count if no others are there."""
        parts = self._parts(self.version())
        known = [v for v in parts if v != NO_VALUE]
        return self._rows(parts[max(known)]) if known else latest_snapshot(self._rows(parts.get(NO_VALUE, [])), self.column)

    def _written(self, df: DataFrame) -> dict[str, list[str]]:
        place = f"data/{uuid.uuid4().hex}"
        rows = aligned(df, self.schema).withColumn(COPY, F.col(self.column)).hint("rebalance", COPY)
        rows.write.mode("error").partitionBy(COPY).parquet(f"{self.path}/{place}")
        names = [n for n in self.storage.names(f"{self.path}/{place}") if n.startswith(f"{COPY}=")]
        return {unquote(n.partition("=")[2]): [f"{place}/{n}"] for n in names}

    def append(self, df: DataFrame) -> None:
        """Add rows: of new copies, or further ones of stored copies."""
        written = self._written(df)
        while True:
            base = self.manifests.newest()
            parts = self._parts(base)
            merged = {v: parts.get(v, []) + written.get(v, []) for v in {**parts, **written}}
            if self.manifests.add(base + 1, {"parts": merged}):
                return

    def replace(self, df: DataFrame, after: int | None = None) -> None:
        """Store ``df`` in place of all copies, and let go of what was replaced long ago.

        ``after`` is the version that ``df`` was made from; fails if another job has committed one since.
        """
        base = self.manifests.newest() if after is None else after
        if not self.manifests.add(base + 1, {"parts": self._written(df)}):
            raise FileExistsError(f"another job has written {self.path} meanwhile")
        self.vacuum()

    def adopt(self, df: DataFrame) -> None:
        """Store ``df`` as the first version, unless another job has just done so."""
        self.manifests.add(1, {"parts": self._written(df)})

    def ensure(self) -> None:
        """Create the table, empty, if it is absent."""
        if self.version() is None:
            self.manifests.add(1, {"parts": {}})

    def vacuum(self) -> None:
        """Delete manifests replaced more than a day ago, and the folders that only they name."""
        numbers, now = self.manifests.numbers(), time.time()
        gone = [n for n, successor in zip(numbers, numbers[1:]) if self.manifests.written(successor) < now - KEPT_SECONDS]

        def named(chosen) -> set[str]:
            return {f for n in chosen for folders in self._parts(n).values() for f in folders}

        for folder in named(gone) - named(n for n in numbers if n not in gone):
            self.storage.delete(f"{self.path}/{folder}")
        for n in gone:
            self.manifests.remove(n)
