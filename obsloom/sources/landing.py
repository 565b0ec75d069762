"""The landing area: six named tables under one folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obsloom.functions.calendar import iso_timestamp
from obsloom.operators.incremental import high_water, new_rows, stamp
from obsloom.operators.skew import same_keys
from obsloom.session import materialise
from obsloom.sources import files
from obsloom.sources.keyed import KeyedLog
from obsloom.sources.schemas import LANDING, MALFORMED, without
from obsloom.sources.snapshots import SnapshotTable
from obsloom.sources.storage import Storage
from obsloom.sources.versioned import VersionedTable

FACTS = ("land_obs_daily", "land_obs_hourly")
STATIONS = "land_obs_stations"
HIGH_WATER = "land_obs_high_water"
#: Logs of one row per station and table, with the column whose greatest value counts, if not the latest row.
LOGS = {"land_obs_load_log": None, "land_obs_attempt_log": None, HIGH_WATER: "last_time"}
MONTH = "obs_month"


class Landing:
    """Reads and extends the landing tables. Observations are stored by month."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def small(self, name: str) -> VersionedTable | KeyedLog | SnapshotTable:
        if name in LOGS:
            return KeyedLog(self.spark, self.path(name), LANDING[name], ["station_id", "table_name"], LOGS[name])
        versions = VersionedTable(self.spark, self.path(name), LANDING[name])
        if name != STATIONS:
            return versions
        copies = SnapshotTable(self.spark, self.path(name), LANDING[name], "snapshot_time")
        if copies.version() is None and versions.version() is not None:
            copies.adopt(versions.read())  # stored before copies had folders of their own
        return copies

    def newest_stations(self) -> DataFrame:
        """The newest station snapshot; older ones are not read."""
        return self.small(STATIONS).newest()

    def source(self, name: str, months=None) -> DataFrame:
        """A landing table with its declared schema; empty if nothing has landed yet. Observations of some ``months`` if given."""
        if name not in FACTS:
            return self.small(name).read()
        facts = self._facts(name)
        if months is not None:
            facts = facts.where(F.col(MONTH).isin(sorted(months)))
        return facts.select(*LANDING[name].names)

    def fingerprints(self) -> dict[str, dict[str, str]]:
        """What has landed, in short: for every month of observations the number and bytes of its files, which each landing
        changes; for the other tables their version."""
        storage = Storage(self.spark)
        found = {}
        for name in LANDING:
            if name in FACTS:
                folders = [f for f in storage.names(self.path(name)) if f.startswith(f"{MONTH}=")]
                found[name] = {f.partition("=")[2]: "%d files, %d bytes" % storage.size(f"{self.path(name)}/{f}") for f in folders}
            elif name not in LOGS:
                found[name] = {"": str(self.small(name).version())}
        return found

    def _facts(self, name: str) -> DataFrame:
        schema = StructType([*LANDING[name], StructField(MONTH, StringType())])
        if not files.path_exists(self.spark, self.path(name), schema):
            return self.spark.createDataFrame([], schema)
        return files.read_parquet(self.spark, self.path(name), schema)

    def load_csv(self, path: str, name: str, loaded_at: Column) -> None:
        """Replace a table by a delivered CSV, whose header must agree; malformed rows are set aside, unless all are."""
        schema = without(LANDING[name], "last_load_time")
        read = files.read_delivered(self.spark, path, schema, "csv", enforceSchema=False, escape='"')
        delivered = self.set_aside(read, name)
        if delivered.isEmpty() and not read.isEmpty():
            raise ValueError(f"every row of {path} is malformed")
        text = F.date_format(loaded_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        self.small(name).replace(delivered.withColumn("last_load_time", F.concat(text, F.lit("+00:00"))))

    def load_stations(self, path: str, array: bool = False) -> None:
        """Append a delivered station snapshot; stations of a snapshot that are stored already are left out.

        Malformed records go to a table of their own, as in :meth:`set_aside`.
        """
        stored = self.small(STATIONS)
        delivered = files.read_delivered(self.spark, path, stored.schema, "json", array=array)
        rows = self.set_aside(delivered, "land_obs_stations").dropDuplicates(["id", "snapshot_time"])
        kept = stored.read().select("id", "snapshot_time").distinct()
        stored.append(rows.join(kept, same_keys(rows, kept, ["id", "snapshot_time"]), "left_anti"))

    def land(self, batch: DataFrame, name: str, load_time: Column, station: Column | None = None, dedupe: bool = True) -> None:
        """Stamp a batch of observations and append it.

        With ``dedupe``, rows whose station and time are stored already are left out, so a batch
        that is landed twice adds nothing, and each station and time is stored once. Only the stored
        months that the batch touches are read. Rows without station or time go to a table of their
        own, ``<name>_rejected``.
        """
        month = F.date_format("time", "yyyy-MM").alias(MONTH)
        rows = stamp(batch, load_time, station).select("*", month)
        keyed = F.col("station_id").isNotNull() & F.col("time").isNotNull()
        self._keep_once(rows.where(~keyed), f"{name}_rejected", LANDING[name], apart_from=["load_time", MONTH])
        rows = rows.where(keyed)
        if dedupe:
            months = rows.select(MONTH).distinct()
            stored = self._facts(name).join(F.broadcast(months), MONTH, "left_semi")
            rows = new_rows(rows, stored, ["station_id", "time"])
        files.append(rows, self.path(name), LANDING[name], [MONTH])
        self._raise_marks(name, batch if station is None else batch.withColumn("station_id", station))

    def set_aside(self, delivered: DataFrame, name: str) -> DataFrame:
        """The well-formed rows of a delivery, after its malformed records went to ``<name>_malformed``.

        There each is one row of its file and text, with the number of times that the file has it. A record that is
        delivered again in the same file adds nothing.
        """
        if files.RECORD not in delivered.columns:
            return delivered.drop(files.FILE)
        # Parsed once, whole: a query for some columns would not see what is wrong with the others.
        delivered = materialise(delivered)
        bad = delivered.where(F.col(files.RECORD).isNotNull())
        counted = bad.groupBy(F.col(files.FILE).alias("file"), F.col(files.RECORD).alias("record")).agg(F.count(F.lit(1)).alias("times"))
        self._keep_once(counted, f"{name}_malformed", MALFORMED, apart_from=["times"])
        return delivered.where(F.col(files.RECORD).isNull()).drop(files.FILE, files.RECORD)

    def _keep_once(self, rows: DataFrame, name: str, schema: StructType, apart_from: list[str]) -> None:
        """Append the rows that are not stored yet, compared without some columns."""
        if rows.isEmpty():
            return
        if files.path_exists(self.spark, self.path(name), schema):
            keys = [c for c in schema.names if c not in apart_from]
            stored = files.read_parquet(self.spark, self.path(name), schema).select(*keys).distinct()
            rows = rows.join(stored, same_keys(rows, stored, keys), "left_anti")
        files.append(rows, self.path(name), schema)

    def _raise_marks(self, name: str, batch: DataFrame) -> None:
        """Keep the latest stored time per station beside the log, so that planning reads no facts.

        The first landing takes the times of what was stored before from the facts themselves.
        """
        marks = self.small(HIGH_WATER)
        if marks.version() is None:
            for t in FACTS:
                marks.append(high_water(self._facts(t), "station_id", "time").withColumn("table_name", F.lit(t)))
        else:
            keyed = batch.where(F.col("station_id").isNotNull() & F.col("time").isNotNull())
            marks.append(high_water(keyed, "station_id", "time").withColumn("table_name", F.lit(name)))

    def marks(self, name: str) -> DataFrame | None:
        """``(station_id, last_time)`` of a table of observations; None before anything has landed."""
        marks = self.small(HIGH_WATER)
        if marks.version() is None:
            return None
        return marks.read().where(F.col("table_name") == name).select("station_id", "last_time")


def bounds_as_text(ts) -> Column:
    """A UTC timestamp in the text form that station bounds use."""
    return F.concat(F.date_format(iso_timestamp(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
