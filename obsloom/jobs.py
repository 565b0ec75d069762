"""Jobs for ``spark-submit``: load, plan, land, build and check.

``spark-submit obsloom/jobs.py build --landing s3a://lake/landing --out s3a://lake/marts``
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from obsloom.functions.calendar import utc, utc_now
from obsloom.plans import loads
from obsloom.plans.checks import declared, differences, run_checks
from obsloom.plans.refresh import refresh
from obsloom.plans.warehouse import ARCHIVE, MARTS, SERVE, SHARED, Warehouse, over
from obsloom.session import configure
from obsloom.sources import files
from obsloom.sources.landing import FACTS, Landing
from obsloom.sources.published import Published
from obsloom.sources.schemas import LANDING, without
from obsloom.streaming.landing import stream_land


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="obsloom")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--landing", required=True, help="folder of the landing tables")
        sub.add_argument("--now", type=dt.datetime.fromisoformat, help="UTC time to use instead of the clock's")
        return sub

    build = command("build", "publish the marts, serve and archive tables: the months and tables that landed data changes")
    build.add_argument("--full", action="store_true", help="build everything")
    build.add_argument("--out", required=True)
    build.add_argument("--calendar-end", type=dt.date.fromisoformat)
    build.add_argument("--tables", nargs="+", default=[*MARTS, *SERVE, *ARCHIVE])

    check = command("check", "run the declared data tests; fails if one does")
    check.add_argument("--marts", required=True, help="folder that build wrote")

    cities = command("load-cities", "replace the city lists by delivered CSV files")
    cities.add_argument("--coord")
    cities.add_argument("--pop")

    stations = command("load-stations", "append a delivered station snapshot")
    stations.add_argument("--json", required=True)
    stations.add_argument("--array", action="store_true", help="one array per file instead of one record per line")

    plan = command("plan", "write which stations to fetch next, and for which time")
    land = command("land", "land delivered observations of planned stations and log them")
    for sub in (plan, land):
        sub.add_argument("--table", choices=FACTS, required=True)
        sub.add_argument("--incremental", action="store_true")
        sub.add_argument("--plan", required=True, help="folder of the plan")
    plan.add_argument("--countries", nargs="*", default=["US"], help="none given: all")
    plan.add_argument("--states", nargs="*", default=[])
    plan.add_argument("--batch-size", type=int)
    plan.add_argument("--all", action="store_true", help="all stations that qualify")
    land.add_argument("--log-failures", action="store_true")

    stream = command("stream", "land files as they arrive")
    stream.add_argument("--table", choices=FACTS, required=True)
    stream.add_argument("--progress", required=True)
    stream.add_argument("--every", help="for example '30 seconds'; without it the run ends once all files are in")
    for sub in (land, stream):
        sub.add_argument("--files", required=True)
        sub.add_argument("--format", choices=("json", "parquet", "csv"), default="parquet")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None):
    """Run one job; returns what it wrote or found."""
    args = _arguments(argv)
    landing = Landing(spark, args.landing)
    now = utc(args.now) if args.now else utc_now()
    return _JOBS[args.command](spark, landing, now, args)


def _build(spark, landing, now, args):
    return refresh(landing, args.out, args.calendar_end, args.tables, args.full)


def _check(spark, landing, now, args):
    stored = Published(spark, args.marts).snapshot()
    wrong = differences(stored, declared(spark))
    if wrong:
        raise SystemExit("\n".join(wrong))
    shared = {model: stored.read(name) for model, name in SHARED.items()}
    warehouse = over(Warehouse(landing.source, newest_stations=landing.newest_stations), merged=shared.pop("_obs_daily_all_qc"), **shared)
    results = run_checks(lambda name: stored.read(name) if name in MARTS else getattr(warehouse, name), stored.nulls).collect()  # one row per declared test
    failed = [r for r in results if r["failures"]]
    if failed:
        raise SystemExit("\n".join(f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed))
    return results


def _load_cities(spark, landing, now, args):
    for path, name in ((args.coord, "land_city_coord"), (args.pop, "land_city_pop")):
        if path:
            landing.load_csv(path, name, now)


def _load_stations(spark, landing, now, args):
    landing.load_stations(args.json, array=args.array)


def _plan(spark, landing, now, args):
    chosen = {"countries": args.countries, "states": args.states}
    if args.all:
        chosen["batch_size"] = None
    elif args.batch_size is not None:
        chosen["batch_size"] = args.batch_size
    planned = (
        loads.next_incremental(landing, args.table, now, **chosen)
        if args.incremental
        else loads.next_initial(landing, args.table, **chosen)
    )
    planned.write.mode("overwrite").parquet(args.plan)


def _land(spark, landing, now, args):
    schema = without(LANDING[args.table], "load_time")
    delivered = landing.set_aside(files.read_delivered(spark, args.files, schema, args.format), args.table)
    planned = spark.read.parquet(args.plan)
    if args.incremental:
        loads.land_increment(landing, delivered, args.table, planned, now)
    else:
        loads.land_and_log(landing, delivered, args.table, planned, now, args.log_failures)


def _stream(spark, landing, now, args):
    stream_land(landing, args.files, args.table, args.progress, file_format=args.format, every=args.every).awaitTermination()


_JOBS = {
    "build": _build,
    "check": _check,
    "load-cities": _load_cities,
    "load-stations": _load_stations,
    "plan": _plan,
    "land": _land,
    "stream": _stream,
}


if __name__ == "__main__":
    run(configure(SparkSession.builder.appName("obsloom")).getOrCreate())
