"""Continuous rollup of a finer series to days."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from obsloom.functions.calendar import utc
from obsloom.functions.keys import surrogate_key
from obsloom.operators.rollup import measures
from obsloom.sources.storage import CommitLog


def _utc_instant(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need an instant: read a zone-free time as UTC, whatever the session's zone."""
    if not isinstance(df.schema[time].dataType, TimestampNTZType):
        return df
    epoch = utc(dt.datetime(1970, 1, 1))
    return df.withColumn(time, F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(time))))


def _utc_date(instant: str):
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / F.lit(86400)).cast("int"))


def stream_rollup(
    stream: DataFrame,
    *,
    key: str,
    time: str,
    date_as: str,
    spec: list[tuple[str, str, str]],
    watermark: str,
) -> DataFrame:
    """The daily rollup over a stream. A day closes once ``watermark`` has passed behind the newest row."""
    return (
        _utc_instant(stream, time)
        .withWatermark(time, watermark)
        .groupBy(F.window(time, "1 day").alias("_window"), key)
        .agg(*measures(spec))
        .select(key, _utc_date("_window.start").alias(date_as), *[out for out, _, _ in spec])
    )


class Updates:
    """The changed days of all micro-batches, as runs of levels.

    A micro-batch is a run of level 0. ``fan_in`` runs of a level become one of the next, in which each key and day has
    its newest state only, so there are fewer than ``fan_in`` runs a level, and a state is rewritten once per level. The
    runs that count are named by one numbered record after another; what an interrupted batch or merge left is not read.
    """

    def __init__(self, spark: SparkSession, path: str, fan_in: int = 8):
        self.spark, self.path, self.fan_in = spark, path, fan_in
        self.log = CommitLog(spark, f"{path}/_runs")

    def runs(self) -> list[dict]:
        """Folder, level and last micro-batch of every run, oldest first."""
        number = self.log.newest()
        return self.log.read(number)["runs"] if number else []

    def read(self, runs: list[dict] | None = None) -> DataFrame:
        """All runs' rows, with the micro-batch of each."""
        runs = self.runs() if runs is None else runs
        return self.spark.read.parquet(*[f"{self.path}/{r['folder']}" for r in runs])

    def add(self, rows: DataFrame, batch_id: int, keys: list[str]) -> None:
        """Write a micro-batch, once however often it is repeated, and merge the runs that are due."""
        if all(r["last"] < batch_id for r in self.runs()):
            run = {"folder": self._written(rows.withColumn("batch", F.lit(batch_id))), "level": 0, "last": batch_id}
            self._commit([*self.runs(), run])
        level = 0
        while len(due := [r for r in self.runs() if r["level"] == level]) >= self.fan_in:
            values = [c for c in rows.columns if c not in keys]
            merged = newest_state(self.read(due), keys, values).select(*rows.columns, "batch")
            run = {"folder": self._written(merged), "level": level + 1, "last": due[-1]["last"]}
            self._commit([r for r in self.runs() if r["level"] > level] + [run])
            for r in due:
                self.log.storage.delete(f"{self.path}/{r['folder']}")
            level += 1

    def _commit(self, runs: list[dict]) -> None:
        number = self.log.newest()
        if not self.log.add(number + 1, {"runs": runs}):
            raise RuntimeError(f"another stream writes to {self.path}")
        for old in self.log.numbers()[:-2]:
            self.log.remove(old)

    def _written(self, rows: DataFrame) -> str:
        folder = f"run-{uuid.uuid4().hex}"
        rows.write.mode("error").parquet(f"{self.path}/{folder}")
        return folder


def newest_state(updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The row of the newest micro-batch for each key, by a rank that Spark cuts off before the shuffle."""
    latest = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    ranked = updates.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1")
    return ranked.select(*keys, *values, "batch")


def write_updates(
    rolled: DataFrame, path: str, checkpoint: str, keys: list[str], every: str | None = None, fan_in: int = 8
) -> StreamingQuery:
    """Write each micro-batch's changed days as a run of :class:`Updates`. ``keys`` are the key and the date."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        Updates(batch.sparkSession, path, fan_in).add(batch, batch_id, keys)

    writer = (
        rolled.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    )
    return writer.trigger(**_trigger(every)).start()


def write_closed(rolled: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write each day once, when its watermark has passed. The file sink commits a batch as a whole."""
    writer = rolled.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start(path)


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def current_days(updates: DataFrame, key: str, date: str, key_name: str = "station_date_id") -> DataFrame:
    """The newest state of each key and day from the written updates (``Updates.read``)."""
    values = [c for c in updates.columns if c not in (key, date, "batch")]
    return newest_state(updates, [key, date], values).select(surrogate_key([key, date]).alias(key_name), key, date, *values)
