"""Newest snapshot of a dimension that is kept as repeated full copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.functions.lookups import lookup_table


def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    """Rows whose ``ts`` equals the greatest one. The broadcast side is a single row."""
    newest = df.agg(F.max(ts).alias("_newest"))
    return df.join(F.broadcast(newest), df[ts] == newest["_newest"]).drop("_newest")


def with_label(df: DataFrame, code: str, label: str, mapping: dict[str, str]) -> DataFrame:
    """Add the label of ``code`` from a fixed mapping; null for other codes."""
    table = lookup_table(df.sparkSession, mapping, "_code", label)
    return df.join(F.broadcast(table), df[code] == table["_code"], "left").drop("_code")
