"""Continuous landing of delivered observation files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obsloom.functions.calendar import utc_now
from obsloom.plans.loads import log_loaded
from obsloom.sources.files import FILE, PERMISSIVE, delivered_schema
from obsloom.sources.landing import Landing
from obsloom.sources.schemas import LANDING, without


def stream_land(
    landing: Landing,
    directory: str,
    table: str,
    checkpoint: str,
    *,
    file_format: str = "json",
    options: dict | None = None,
    max_files: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Land files as they arrive and log their stations.

    Each micro-batch sets malformed records aside, lands its rows and then adds to the log, all safe to repeat. Without
    ``every`` the run takes what is there and ends; with it (for example ``30 seconds``) it goes on.
    """
    spark = landing.spark
    schema = without(LANDING[table], "load_time")
    reader = spark.readStream.schema(delivered_schema(schema) if file_format in PERMISSIVE else schema).format(file_format)
    for name, value in {**PERMISSIVE.get(file_format, {}), **(options or {})}.items():
        reader = reader.option(name, value)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def land_batch(batch: DataFrame, _batch_id: int) -> None:
        now = utc_now()
        rows = landing.set_aside(batch, table).persist()  # read for the months, the rows and the log
        try:
            landing.land(rows, table, now)
            log_loaded(landing, table, rows.select("station_id").dropna().distinct(), now)
        finally:
            rows.unpersist()

    delivered = reader.load(directory).select("*", F.col("_metadata.file_path").alias(FILE))
    writer = delivered.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land_batch)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
