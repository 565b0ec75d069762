"""Helpers shared by the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsloom.functions.keys import NULL_TOKEN
from obsloom.session import ensure_checkpoint_dir


@dataclass
class Registry:
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None):
        """Register the decorated function under ``name`` with its SQL, if it has one."""

        def register(function):
            self.queries[name] = function
            if sql is not None:
                self.oracles[name] = sql
            return function

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the place all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/run-{uuid.uuid4().hex}"


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that sums taken in another order compare equal."""
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def labelled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep infinities and NaN out of ``columns``; they are named in ``<column>_label``."""
    for c in columns:
        special = F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
        label = F.when(F.isnan(c), "nan").when(F.col(c) == float("inf"), "inf").when(F.col(c) == float("-inf"), "-inf")
        df = df.withColumn(f"{c}_label", label).withColumn(c, F.when(~special, F.col(c)))
    return df


# SQL counterparts.


def sql_rounded(value: str, places: int = 6) -> str:
    """Rounded without a negative zero."""
    return f"(round({value}, {places}) + 0.0)"


def sql_round(column: str, places: int = 6) -> str:
    return f"{sql_rounded(column, places)} AS {column.split('.')[-1]}"


def sql_select(columns: list[str], doubles, source: str, labels=()) -> str:
    """Select ``columns`` with doubles rounded and special values labelled."""
    items = []
    for c in columns:
        if c in labels:
            items.append(f"CASE WHEN isfinite({c}) THEN {sql_rounded(c)} END AS {c}")
            items.append(
                f"CASE WHEN isnan({c}) THEN 'nan' WHEN {c} = 'inf'::DOUBLE THEN 'inf' "
                f"WHEN {c} = '-inf'::DOUBLE THEN '-inf' END AS {c}_label"
            )
        else:
            items.append(sql_round(c) if c in doubles else c)
    return f"SELECT {', '.join(items)} FROM {source}"


def sql_key(*columns: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in columns)
    return f"md5({parts})"


def sql_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"7918 * asin(sqrt(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)))"
    )


def sql_ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def sql_gaps(base: str, key: str, date: str, metric: str, min_run: int) -> str:
    """CTEs ``bounds``, ``spine``, ``runs``, ``gap_sum`` over ``base``: every day of every key, as the plain form does it."""
    return f"""
bounds AS (SELECT {key}, min({date}) AS lo, max({date}) AS hi, count(DISTINCT {date}) AS days FROM {base} GROUP BY {key}),
spine AS (
  SELECT b.{key}, CAST(s.d AS DATE) AS d, CASE WHEN x.{metric} IS NULL THEN 1 ELSE 0 END AS gap
  FROM bounds b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS s(d)
  LEFT JOIN {base} x ON x.{key} = b.{key} AND x.{date} = CAST(s.d AS DATE)
),
runs AS (
  SELECT {key}, run, count(*) AS len FROM (
    SELECT *, date_diff('day', DATE '1970-01-01', d) - row_number() OVER (PARTITION BY {key} ORDER BY d) AS run
    FROM spine WHERE gap = 1
  ) GROUP BY {key}, run
),
gap_sum AS (
  SELECT {key}, CAST(sum(len) AS BIGINT) AS total_gap_days,
    CAST(coalesce(sum(len) FILTER (WHERE len >= {min_run}), 0) AS BIGINT) AS long_gap_count,
    CAST(count(*) FILTER (WHERE len >= {min_run}) AS BIGINT) AS long_gap_periods
  FROM runs GROUP BY {key}
)"""
