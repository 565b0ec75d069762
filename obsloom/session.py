"""Session settings the operators rely on, and the checkpoint folder they share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.checkpoint.compress": "true",
    # Checkpoints go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # State of long-running rollups is kept on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_TASK_BYTES = 128 * 1024 * 1024


def sized_for(shuffled_bytes: int) -> dict[str, str]:
    """Settings under which ``shuffled_bytes`` are cut into tasks of about 128 MB."""
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffled_bytes // _TASK_BYTES))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * _TASK_BYTES),
    }


def configure(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """Apply the library defaults (and any overrides) to a session builder."""
    for name, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    return builder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; where none is set, make a folder in local mode and raise elsewhere."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared and not context.master.startswith("local[") and context.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="obsloom-checkpoint-"))


def materialise(df):
    """Cut lineage with a reliable checkpoint, so values fixed by one run stay fixed."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
