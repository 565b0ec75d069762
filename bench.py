"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Each query is run to a
``noop`` sink, which computes every row and column.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from obsloom.registered.catalog import REGISTRY
from obsloom.session import configure

HEADLINE = (
    "rollup_daily",
    "merge_sources",
    "merge_sources_qc",
    "window_expand",
    "coverage",
    "gaps",
    "qc_summary",
    "token_match",
    "proximity_match",
    "latest_snapshot",
    "date_dim",
    "stations_dim",
    "row_id",
    "rank_within",
    "unpivot_metrics",
    "serve_float",
    "serve_compact",
    "obs_obt",
    "plan_initial",
    "plan_incremental_hourly",
    "upsert_log",
    "update_bounds",
    "dq_unique",
    "dq_relationship",
    "obs_stream_rollup",
    "land_hourly",
    "model_obs_hourly_day_sum",
    "model_obs_daily_all_qc",
    "model_mart_obs_window_fact",
    "model_mart_stations_dim",
    "model_mart_city_dim",
    "model_mart_city_station_bridge",
    "model_mart_station_obs_qc_obt",
    "model_mart_obs_fact_unpiv",
    "model_mart_station_obs_obt",
    "build_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench"),
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        REGISTRY.queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
