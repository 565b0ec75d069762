"""Loading, storing and streaming over the driver's tables, read back and compared with them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from obsloom.functions.calendar import utc
from obsloom.operators.incremental import log_rows
from obsloom.plans.checks import run_checks
from obsloom.plans.loads import land_and_log, land_increment, next_incremental, next_initial
from obsloom.plans.refresh import refresh
from obsloom.plans.tested import NOT_NULL, RELATIONSHIPS, UNIQUE
from obsloom.plans.warehouse import ARCHIVE, MARTS, SERVE, Warehouse, build_all
from obsloom.registered.bindings import LANDING_SQL, landing_source
from obsloom.registered.common import Registry, rounded, scratch, sql_key, sql_round, table
from obsloom.registered.models import CALENDAR_END, ORACLES, with_models
from obsloom.sources import files
from obsloom.sources.keyed import KeyedLog
from obsloom.sources.landing import FACTS, Landing
from obsloom.sources.published import Published
from obsloom.sources.schemas import LANDING, without
from obsloom.sources.snapshots import SnapshotTable
from obsloom.sources.versioned import VersionedTable
from obsloom.streaming.landing import stream_land
from obsloom.streaming.rollup import Updates, current_days, stream_rollup, write_updates

_NOW = dt.datetime(2024, 2, 1, 6)
_STAMP = "2024-02-01T06:00:00.000000+00:00"
_SUPPLIER = StructType(
    [
        StructField("s_suppkey", LongType()),
        StructField("s_name", StringType()),
        StructField("s_nationkey", IntegerType()),
        StructField("s_acctbal", DoubleType()),
    ]
)


def _now():
    return utc(_NOW)


def _obs_columns(name: str) -> list[str]:
    return [c for c in LANDING[name].names if c not in ("load_time", "station_id", "time")]


def _landed_sql(name: str, where: str = "true") -> str:
    metrics = ", ".join(sql_round(c) for c in _obs_columns(name))
    return f"WITH landed AS ({LANDING_SQL[name]}) SELECT station_id, CAST(time AS TIMESTAMP) AS time, {metrics}, '{_STAMP}' AS load_time FROM landed WHERE {where}"


def _landed(landing: Landing, name: str):
    return rounded(landing.source(name).select("station_id", "time", *_obs_columns(name), "load_time"))


def _register_files(registry: Registry) -> None:
    @registry.add(
        "csv_replace",
        f"WITH c AS ({LANDING_SQL['land_city_coord']}) SELECT UACE, GEOID, GEOID_2, NAME, NAME_2, AREA_LAND, AREA_WATER, LATITUDE, LONGITUDE, "
        f"'{_STAMP}' AS last_load_time FROM c",
    )
    def csv_replace(spark, sf_dir):
        """Written as CSV, loaded twice: the second load replaces the first."""
        root = scratch(spark)
        coords = landing_source(spark, sf_dir)("land_city_coord").drop("last_load_time")
        coords.write.csv(f"{root}/delivered", header=True, escape='"')
        landing = Landing(spark, root)
        for _ in range(2):
            landing.load_csv(f"{root}/delivered", "land_city_coord", _now())
        return landing.source("land_city_coord")

    @registry.add(
        "json_snapshots",
        f"WITH s AS ({LANDING_SQL['land_obs_stations']}) SELECT * FROM s WHERE snapshot_time < '2024-03-01' "
        "UNION ALL SELECT * REPLACE ('2024-04-01T00:00:00+00:00' AS snapshot_time) FROM s WHERE snapshot_time > '2024-03-01'",
    )
    def json_snapshots(spark, sf_dir):
        """Two station snapshots written as JSON records and appended."""
        root = scratch(spark)
        stations = landing_source(spark, sf_dir)("land_obs_stations")
        landing = Landing(spark, root)
        for taken, label in (("2024-02-01T00:00:00+00:00", "old"), ("2024-03-01T00:00:00+00:00", "new")):
            stamp = "2024-04-01T00:00:00+00:00" if label == "new" else taken
            files.write_json(stations.filter(F.col("snapshot_time") == taken).drop("snapshot_time"), f"{root}/{label}", F.lit(stamp))
            landing.load_stations(f"{root}/{label}", array=False)
        return landing.source("land_obs_stations")

    @registry.add("json_array_snapshots", LANDING_SQL["land_obs_stations"])
    def json_array_snapshots(spark, sf_dir):
        """Stations delivered as files of one JSON array each, loaded twice and stored once."""
        root = scratch(spark)
        stations = landing_source(spark, sf_dir)("land_obs_stations")
        arrays_of = -(-stations.count() // 500)  # an array has about as many records, however many stations there are
        arrays = stations.groupBy(F.pmod(F.xxhash64("id"), F.lit(arrays_of)).alias("file")).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
        arrays.repartition("file").write.partitionBy("file").text(f"{root}/delivered")
        landing = Landing(spark, root)
        for _ in range(2):
            landing.load_stations(f"{root}/delivered", array=True)
        return landing.source("land_obs_stations")

    @registry.add("append_or_create", "SELECT * FROM supplier")
    def append_or_create(spark, sf_dir):
        """Two appends in another column order: the first creates the table."""
        path = f"{scratch(spark)}/supplier"
        supplier = table(spark, sf_dir, "supplier")
        even = F.col("s_suppkey") % 2 == 0
        assert not files.path_exists(spark, path, _SUPPLIER)
        files.append(supplier.filter(even), path, _SUPPLIER)
        files.append(supplier.filter(~even).select(*reversed(supplier.columns)), path, _SUPPLIER)
        return files.read_parquet(spark, path, _SUPPLIER)

    @registry.add("versioned_replace", "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 1, 6) AS s_acctbal FROM supplier")
    def versioned_replace(spark, sf_dir):
        """A table rewritten from itself."""
        stored = VersionedTable(spark, f"{scratch(spark)}/supplier", _SUPPLIER)
        stored.ensure()
        stored.replace(table(spark, sf_dir, "supplier"))
        stored.replace(stored.read().withColumn("s_acctbal", F.col("s_acctbal") + 1))
        return rounded(stored.read())

    @registry.add(
        "newest_copy",
        "WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS taken, o_totalprice FROM orders) "
        "SELECT o_orderkey, taken, round(o_totalprice, 6) AS o_totalprice FROM o WHERE taken = (SELECT max(taken) FROM o)",
    )
    def newest_copy(spark, sf_dir):
        """Copies of months appended in two halves; of the stored ones the newest is read alone."""
        rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("taken"), "o_totalprice")
        stored = SnapshotTable(spark, f"{scratch(spark)}/orders", rows.schema, "taken")
        for half in (0, 1):
            stored.append(rows.where(F.col("o_orderkey") % 2 == half))
        return rounded(stored.newest())

    @registry.add("view_and_table", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
    def view_and_table(spark, sf_dir):
        counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        files.as_view(counts, "obsloom_priority_counts")
        assert files.table_exists(spark, "obsloom_priority_counts")
        return files.as_table(spark.table("obsloom_priority_counts"), scratch(spark), "priority_counts")


def _register_loads(registry: Registry) -> None:
    @registry.add("land_hourly", _landed_sql("land_obs_hourly"))
    def land_hourly(spark, sf_dir):
        """One batch landed twice is stored once."""
        landing = Landing(spark, scratch(spark))
        batch = landing_source(spark, sf_dir)("land_obs_hourly").drop("load_time")
        for _ in range(2):
            landing.land(batch, "land_obs_hourly", _now())
        return _landed(landing, "land_obs_hourly")

    @registry.add("land_conflicts", _landed_sql("land_obs_hourly").replace("FROM landed", "FROM (SELECT * REPLACE (pres + 1 AS pres) FROM landed)"))
    def land_conflicts(spark, sf_dir):
        """Two readings of every station and time in one batch, landed twice: one of them is stored."""
        landing = Landing(spark, scratch(spark))
        batch = landing_source(spark, sf_dir)("land_obs_hourly").drop("load_time")
        for _ in range(2):
            landing.land(batch.unionByName(batch.withColumn("pres", F.col("pres") + 1)), "land_obs_hourly", _now())
        return _landed(landing, "land_obs_hourly")

    @registry.add(
        "rejected_rows",
        _landed_sql("land_obs_hourly").replace("SELECT station_id,", "SELECT CASE WHEN hour(time) <> 3 THEN station_id END AS station_id,", 1),
    )
    def rejected_rows(spark, sf_dir):
        """Rows without a station go to a table of their own; together with the others none is missing."""
        landing = Landing(spark, scratch(spark))
        batch = landing_source(spark, sf_dir)("land_obs_hourly").drop("load_time")
        landing.land(batch.withColumn("station_id", F.when(F.hour("time") != 3, F.col("station_id"))), "land_obs_hourly", _now())
        rejected = spark.read.parquet(landing.path("land_obs_hourly_rejected"))
        return _landed(landing, "land_obs_hourly").unionByName(rounded(rejected.select("station_id", "time", *_obs_columns("land_obs_hourly"), "load_time")))

    @registry.add(
        "malformed_rows",
        "SELECT 'landed' AS kind, CAST(user_id AS VARCHAR) AS record, CAST(ts AS TIMESTAMP) AS time, CAST(1 AS BIGINT) AS times FROM events WHERE event_id % 7 <> 3 "
        "UNION ALL SELECT 'malformed', concat('{\"time\": ', event_id, ', '), NULL, 2 FROM events WHERE event_id % 7 = 3",
    )
    def malformed_rows(spark, sf_dir):
        """Records cut off in the middle, twice in their file, are set aside once; delivered again, nothing is added."""
        root = scratch(spark)
        events = table(spark, sf_dir, "events")
        good = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"), F.col("user_id").cast("string").alias("station_id"), F.col("value").alias("temp")))
        broken = F.concat(F.lit('{"time": '), F.col("event_id").cast("string"), F.lit(", "))
        lines = F.when(F.col("event_id") % 7 == 3, F.array(broken, broken)).otherwise(F.array(good))
        events.select(F.explode(lines).alias("value")).write.text(f"{root}/delivered")
        landing, name = Landing(spark, root), "land_obs_hourly"
        for _ in range(2):
            delivered = files.read_delivered(spark, f"{root}/delivered", without(LANDING[name], "load_time"), "json")
            landing.land(landing.set_aside(delivered, name), name, _now())
        landed = landing.source(name).select(F.lit("landed").alias("kind"), F.col("station_id").alias("record"), "time", F.lit(1).cast("long").alias("times"))
        aside = spark.read.parquet(landing.path(f"{name}_malformed"))
        return landed.unionByName(aside.select(F.lit("malformed").alias("kind"), "record", F.lit(None).cast("timestamp_ntz").alias("time"), "times"))

    @registry.add(
        "upsert_log_compacted",
        "SELECT CAST(user_id AS VARCHAR) AS station_id, TIMESTAMP '2024-02-01 06:00:00' + to_days(CAST(max(event_id % 10) AS INTEGER)) AS last_fetched, "
        "'land_obs_hourly' AS table_name FROM events GROUP BY user_id",
    )
    def upsert_log_compacted(spark, sf_dir):
        """Ten loads logged one after another as changes; every few of them become a snapshot."""
        log = KeyedLog(spark, scratch(spark), LANDING["land_obs_load_log"], ["station_id", "table_name"], fan_in=4)
        events = table(spark, sf_dir, "events")
        for k in range(10):
            loaded = events.where(F.col("event_id") % 10 == k).select(F.col("user_id").cast("string").alias("station_id"))
            log.append(log_rows(loaded, "land_obs_hourly", utc(_NOW + dt.timedelta(days=k))))
        assert len(log.folders()) <= 4
        return log.read()

    pending = (
        "SELECT id FROM s WHERE snapshot_time = (SELECT max(snapshot_time) FROM s) AND daily_start IS NOT NULL AND daily_end IS NOT NULL AND country = 'US'"
    )

    @registry.add(
        "initial_load",
        f"WITH s AS ({LANDING_SQL['land_obs_stations']}), d AS ({LANDING_SQL['land_obs_daily']}) "
        f"SELECT DISTINCT station_id, TIMESTAMP '{_NOW}' AS last_fetched, 'land_obs_daily' AS table_name FROM d WHERE station_id IN ({pending})",
    )
    def initial_load(spark, sf_dir):
        """Plan all pending stations, land what they delivered, log them; then plan again."""
        source = landing_source(spark, sf_dir)
        landing = Landing(spark, scratch(spark))
        landing.small("land_obs_stations").append(source("land_obs_stations"))
        planned = next_initial(landing, "land_obs_daily", batch_size=None)
        delivered = source("land_obs_daily").drop("load_time").join(planned.select("station_id"), "station_id", "left_semi")
        land_and_log(landing, delivered, "land_obs_daily", planned, _now())
        again = next_initial(landing, "land_obs_daily", batch_size=None).join(
            landing.source("land_obs_load_log"), "station_id", "left_semi"
        )
        assert again.isEmpty()
        return landing.source("land_obs_load_log")

    @registry.add(
        "hourly_increment",
        f"WITH s AS ({LANDING_SQL['land_obs_stations']}), h AS ({LANDING_SQL['land_obs_hourly']}), "
        "high AS (SELECT station_id AS id, max(time) AS last_time FROM h GROUP BY 1), "
        "plan AS (SELECT id, least(CAST(replace(hourly_end, 'Z', '') AS TIMESTAMP), TIMESTAMP '2024-02-01 06:00:00') AS till FROM s LEFT JOIN high USING (id) "
        "WHERE snapshot_time = (SELECT max(snapshot_time) FROM s) AND country = 'US' AND hourly_end IS NOT NULL "
        "AND coalesce(last_time + INTERVAL 1 HOUR, CAST(replace(hourly_start, 'Z', '') AS TIMESTAMP)) <= till) "
        "SELECT id, snapshot_time, coalesce(strftime(till, '%Y-%m-%dT%H:%M:%S') || '+00:00', hourly_end) AS hourly_end FROM s LEFT JOIN plan USING (id)",
    )
    def hourly_increment(spark, sf_dir):
        """Plan by high-water mark; the planned stations' end bound moves on every snapshot row."""
        source = landing_source(spark, sf_dir)
        landing = Landing(spark, scratch(spark))
        landing.small("land_obs_stations").append(source("land_obs_stations"))
        hourly = source("land_obs_hourly").drop("load_time")
        landing.land(hourly, "land_obs_hourly", _now())
        planned = next_incremental(landing, "land_obs_hourly", _now(), batch_size=None)
        delivered = hourly.join(planned.select("station_id"), "station_id", "left_semi")
        land_increment(landing, delivered, "land_obs_hourly", planned, _now())
        return landing.source("land_obs_stations").select("id", "snapshot_time", "hourly_end")

    def model_sql(name: str) -> str:
        hours = "SELECT range AS hour FROM range(0, 23)"
        return f"({hours if name == 'mart_hour_dim' else ORACLES[name]})"

    def repeated(model: str, c: str) -> str:
        return f"SELECT {c} FROM {model_sql(model)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"

    checks = [
        *[(m, c, "unique", repeated(m, c)) for m, columns in UNIQUE.items() for c in columns],
        *[(m, c, "not_null", f"SELECT 1 FROM {model_sql(m)} WHERE {c} IS NULL") for m, columns in NOT_NULL.items() for c in columns],
        *[
            (m, c, "relationships", f"SELECT DISTINCT {c} FROM {model_sql(m)} WHERE {c} NOT IN (SELECT {f} FROM {model_sql(to)})")
            for m, c, to, f in RELATIONSHIPS
        ],
    ]

    @registry.add(
        "model_checks",
        with_models(
            " UNION ALL ".join(
                f"SELECT '{m}' AS model, '{c}' AS column_name, '{t}' AS test, count(*) AS failures FROM ({failing})"
                for m, c, t, failing in checks
            )
        ),
    )
    def model_checks(spark, sf_dir):
        """The declared data tests over the stored tables and the staged landing tables."""
        warehouse = Warehouse(landing_source(spark, sf_dir), calendar_end=CALENDAR_END)
        stored = build_all(warehouse, scratch(spark), MARTS).snapshot()
        return run_checks(lambda name: stored.read(name) if name in stored else getattr(warehouse, name), stored.nulls)

    @registry.add("build_all", with_models(ORACLES["mart_obs_fact"]))
    def build_all_(spark, sf_dir):
        """Every stored table built and exported; the daily fact read back."""
        stored = build_all(Warehouse(landing_source(spark, sf_dir), calendar_end=CALENDAR_END), scratch(spark)).snapshot()
        assert all(name in stored for name in (*MARTS, *SERVE, *ARCHIVE))
        return rounded(stored.read("mart_obs_fact"))

    orders = "o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_day, o_orderstatus, o_totalprice FROM orders"

    @registry.add(
        "mart_versions",
        f"SELECT 'kept' AS version, {orders} WHERE o_orderkey % 2 = 0 UNION ALL "
        f"SELECT 'newest' AS version, {orders} WHERE year(o_orderdate) = 1998 OR year(o_orderdate) = 1997 AND o_orderkey % 2 = 0",
    )
    def mart_versions(spark, sf_dir):
        """A year's months are replaced: a reader that keeps the version before sees it whole, another reads two years of the new one."""
        day = F.to_date("o_orderdate").alias("o_day")
        rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day, "o_orderstatus", "o_totalprice")
        published = Published(spark, scratch(spark))
        first = published.build()
        first.store(rows.where("o_orderkey % 2 = 0"), "orders", "o_day", order=["o_custkey"])
        first.commit()
        kept = published.snapshot()
        second = published.build()
        year = {f"1998-{m:02d}" for m in range(1, 13)}
        second.store(rows.where("year(o_day) = 1998"), "orders", "o_day", months=year, order=["o_custkey"])
        second.commit()
        newest = published.read("orders", since=dt.date(1997, 1, 1), until=dt.date(1998, 12, 31))
        return kept.read("orders").withColumn("version", F.lit("kept")).unionByName(newest.withColumn("version", F.lit("newest")))

    @registry.add(
        "build_increment",
        with_models(ORACLES["mart_obs_window_fact"])
        .replace("FROM events", "FROM moved_events")
        .replace("WITH ", "WITH moved_events AS (SELECT * REPLACE (ts + to_days(CAST(31 * (user_id % 5) AS INTEGER)) AS ts) FROM events), ", 1),
    )
    def build_increment(spark, sf_dir):
        """All but a month is landed and built, then the month is landed and what it changes is built again."""
        moved = table(spark, sf_dir, "events").withColumn("ts", F.expr("ts + make_dt_interval(CAST(31 * (user_id % 5) AS INT))"))
        source = landing_source(spark, sf_dir, events=moved)
        landing, marts = Landing(spark, scratch(spark)), scratch(spark)
        for name in ("land_obs_stations", "land_city_coord", "land_city_pop"):
            landing.small(name).replace(source(name))
        names = ("mart_obs_fact", "mart_obs_window_fact", "mart_stations_dim")
        last = F.date_format("time", "yyyy-MM") == "2024-05"
        built = []
        for part in (~last, last):
            for name in FACTS:
                landing.land(source(name).where(part).drop("load_time"), name, _now(), dedupe=False)
            built.append(refresh(landing, marts, CALENDAR_END, names).snapshot())
        before, after = (s.tables["mart_obs_fact"]["parts"] for s in built)
        assert "2024-05" not in before and before == {m: f for m, f in after.items() if m != "2024-05"}
        return rounded(built[-1].read("mart_obs_window_fact"))


_STREAM_SPEC = [("value_avg", "avg", "value"), ("value_min", "min", "value"), ("value_max", "max", "value"), ("value_sum", "sum", "value")]


def _register_streams(registry: Registry) -> None:
    @registry.add(
        "obs_stream_rollup",
        f"SELECT {sql_key('user_id', 'CAST(ts AS DATE)')} AS user_day_id, user_id, CAST(ts AS DATE) AS event_date, "
        "round(avg(value), 6) AS value_avg, min(value) AS value_min, max(value) AS value_max, round(sum(value), 6) AS value_sum FROM events GROUP BY user_id, CAST(ts AS DATE)",
    )
    def obs_stream_rollup(spark, sf_dir):
        """The events read as a stream of several micro-batches; equal to the batch rollup."""
        root = scratch(spark)
        events = table(spark, sf_dir, "events")
        events.repartition(4, "event_id").write.parquet(f"{root}/arriving")  # a day's rows come in several micro-batches
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arriving")
        rolled = stream_rollup(stream, key="user_id", time="ts", date_as="event_date", spec=_STREAM_SPEC, watermark="60 days")
        write_updates(rolled, f"{root}/updates", f"{root}/progress", ["user_id", "event_date"], fan_in=3).awaitTermination()
        updates = Updates(spark, f"{root}/updates")
        assert max(r["level"] for r in updates.runs()) == 1  # three micro-batches have become one run
        return rounded(current_days(updates.read(), "user_id", "event_date", "user_day_id"))

    @registry.add("stream_land", f"WITH landed AS ({LANDING_SQL['land_obs_hourly']}) SELECT station_id, time, "
                  + ", ".join(sql_round(c) for c in _obs_columns("land_obs_hourly")) + " FROM landed")
    def stream_land_(spark, sf_dir):
        """Delivered files landed by a stream that is run twice."""
        root = scratch(spark)
        landing = Landing(spark, root)
        delivered = landing_source(spark, sf_dir)("land_obs_hourly").select(*without(LANDING["land_obs_hourly"], "load_time").names)
        delivered.write.parquet(f"{root}/delivered")
        for _ in range(2):
            stream_land(landing, f"{root}/delivered", "land_obs_hourly", f"{root}/progress", file_format="parquet").awaitTermination()
        return _landed(landing, "land_obs_hourly").drop("load_time")


def register(registry: Registry) -> None:
    _register_files(registry)
    _register_loads(registry)
    _register_streams(registry)
