"""Time the operators against the plain form of the same result: ``python tools/plain_forms.py [sf_dir]``.

Each pair is checked to give equal rows before it is timed.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.operators import coverage, merge, ranking, rollup, windows
from obsloom.session import configure

SPEC = [("v", "avg", "value"), ("hi", "max", "value")]
KEYS = ["user_id", "d"]


def days(events):
    return rollup.rollup_daily(events, key="user_id", time="ts", date_as="d", spec=SPEC).drop("station_date_id")


def window_plain(frame):
    anchors = frame.select(F.col("user_id").alias("k"), F.col("d").alias("anchor_date")).distinct()
    near = (F.col("k") == F.col("user_id")) & F.col("d").between(F.date_sub("anchor_date", 2), F.date_add("anchor_date", 2))
    return anchors.join(frame, near).select("user_id", "anchor_date", "d", "v", "hi")


def gaps_plain(frame):
    bounds = frame.groupBy("user_id").agg(F.min("d").alias("lo"), F.max("d").alias("hi_d"))
    spine = bounds.select("user_id", F.explode(F.sequence("lo", "hi_d")).alias("d"))
    flags = spine.join(frame, KEYS, "left").select("user_id", "d", F.col("v").isNull().cast("int").alias("gap"))
    by_day = W.partitionBy("user_id").orderBy("d")
    starts = flags.withColumn("start", (F.col("gap") == 1) & (F.coalesce(F.lag("gap").over(by_day), F.lit(0)) == 0))
    runs = starts.withColumn("run", F.sum(F.col("start").cast("int")).over(by_day)).filter("gap = 1")
    lengths = runs.groupBy("user_id", "run").count()
    return lengths.groupBy("user_id").agg(
        F.sum("count").alias("total_gap_days"),
        F.sum(F.when(F.col("count") >= 3, F.col("count")).otherwise(0)).alias("long_gap_count"),
    )


def merge_plain(first, second):
    second = second.withColumnsRenamed({"v": "w", "hi": "whi"})
    left = first.join(second, KEYS, "left").select(
        *KEYS, F.coalesce("v", "w").alias("v"), F.coalesce("hi", "whi").alias("hi")
    )
    return left.unionByName(second.join(first, KEYS, "left_anti").select(*KEYS, F.col("w").alias("v"), F.col("whi").alias("hi")))


def seconds(df) -> float:
    best = float("inf")
    for _ in range(3):
        started = time.perf_counter()
        df().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - started)
    return best


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = configure(
        SparkSession.builder.master("local[8]"),
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_name", "p_partkey")
    frame = days(events)
    first, second = (days(events.filter(F.col("event_type").isin(*k))) for k in (("click", "view"), ("view", "error")))
    pairs = [merge.Pair("v", "v", "v"), merge.Pair("hi", "hi", "hi")]
    forms = {
        "window_expand": (
            lambda: windows.window_expand(frame, key="user_id", date="d").drop("station_obs_window_id"),
            lambda: window_plain(frame),
        ),
        "gaps": (
            lambda: coverage.gaps(frame, key="user_id", date="d", metric="v", min_run=3).select("user_id", "total_gap_days", "long_gap_count"),
            lambda: gaps_plain(frame),
        ),
        "merge_sources": (
            lambda: merge.merge_sources(first, second, keys=KEYS, pairs=pairs).drop("station_date_id"),
            lambda: merge_plain(first, second),
        ),
        "row_id": (
            lambda: ranking.row_id(part, [F.asc("p_name"), F.asc("p_partkey")], "n"),
            lambda: part.select(F.row_number().over(W.orderBy("p_name", "p_partkey")).cast("bigint").alias("n"), "p_name", "p_partkey"),
        ),
    }
    for name, (fast, plain) in forms.items():
        a, b = (f().select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in f().dtypes]) for f in (fast, plain))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
        print(f"{name}: {seconds(fast):.2f} s, plain form {seconds(plain):.2f} s", flush=True)


if __name__ == "__main__":
    main()
