"""Planning, landing, logging, storing and streaming."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from obsloom.functions.calendar import utc
from obsloom.operators import incremental, rollup
from obsloom.plans import loads
from obsloom.plans.warehouse import Warehouse, build_all
from obsloom.sources import files
from obsloom.sources.landing import Landing
from obsloom.sources.schemas import LANDING
from obsloom.sources.versioned import VersionedTable
from obsloom.streaming.landing import stream_land
from obsloom.streaming.rollup import Updates, current_days, stream_rollup, write_closed, write_updates

NOW = dt.datetime(2024, 5, 1, 12)
HOURLY, DAILY, LOG = "land_obs_hourly", "land_obs_daily", "land_obs_load_log"


def now():
    return utc(NOW)


def station(id_, start="2024-01-01T00:00:00+00:00", end="2024-04-01T00:00:00+00:00", country="US", region="NY", taken="2024-02"):
    return (id_, id_, country, region, None, None, 40.0, -70.0, 1.0, "UTC", start, end, start, end, None, None, taken)


def landing_with(spark, tmp_path, *stations):
    landing = Landing(spark, str(tmp_path / "lake"))
    landing.small("land_obs_stations").append(spark.createDataFrame(list(stations), LANDING["land_obs_stations"]))
    return landing


def observations(spark, *pairs):
    data = [(t, 1.0, *[None] * 10, s) for s, t in pairs]
    schema = "time timestamp_ntz, temp double, dwpt double, rhum double, prcp double, snow double, wdir double, wspd double, wpgt double, pres double, tsun double, coco double, station_id string"
    return spark.createDataFrame(data, schema)


def test_initial_plan(spark, tmp_path):
    landing = landing_with(
        spark, tmp_path,
        station("a"), station("b", end=None), station("c", country="CA"), station("d"), station("e"), station("f", region=None),
        station("a", taken="2024-01"),
    )
    landing.small(LOG).replace(spark.createDataFrame([("a", NOW, HOURLY), ("d", NOW, DAILY)], LANDING[LOG]))
    assert [r[0] for r in loads.next_initial(landing, HOURLY, batch_size=2).collect()] == ["d", "e"]
    assert [r[0] for r in loads.next_initial(landing, HOURLY, batch_size=10).collect()] == ["d", "e", "f"]
    assert [r[0] for r in loads.next_initial(landing, HOURLY, countries=[], batch_size=1).collect()] == ["c"]
    assert [r[0] for r in loads.next_initial(landing, HOURLY, states=["NY"], batch_size=None).collect()] == ["d", "e"]


def test_incremental_plan(spark):
    late = "2030-01-01T00:00:00+00:00"
    stations = spark.createDataFrame(
        [station("new"), station("behind"), station("done"), station("future", end=late), station("later", start=late, end=late)],
        LANDING["land_obs_stations"],
    )
    facts = spark.createDataFrame(
        [("behind", dt.datetime(2024, 3, 1, 5)), ("done", dt.datetime(2024, 3, 31, 23, 30)), ("future", dt.datetime(2024, 4, 30, 1))],
        "station_id string, time timestamp_ntz",
    )

    def plan(step):
        planned = incremental.plan_incremental(
            stations, facts, start="hourly_start", end="hourly_end", step=step, now=now(), n=None
        )
        return {r["station_id"]: (r["start"], r["end"]) for r in planned.collect()}

    april = dt.datetime(2024, 4, 1)
    hourly = plan("hour")
    assert hourly == {
        "new": (dt.datetime(2024, 1, 1), april), "behind": (dt.datetime(2024, 3, 1, 6), april),
        "future": (dt.datetime(2024, 4, 30, 2), NOW),
    }
    daily = plan("day")  # by day, a start later on the end's own day still counts
    assert daily["done"] == (dt.datetime(2024, 4, 1, 23, 30), april) and set(daily) == {"new", "behind", "done", "future"}


def test_landing_twice_adds_nothing(spark, tmp_path):
    landing = landing_with(spark, tmp_path, station("a"), station("b"))
    batch = observations(spark, ("a", dt.datetime(2024, 1, 31, 23)), ("a", dt.datetime(2024, 2, 1, 0)))
    planned = loads.next_initial(landing, HOURLY, batch_size=10)
    for _ in range(2):
        loads.land_and_log(landing, batch, HOURLY, planned, now())
    assert landing.source(HOURLY).count() == 2
    assert rows(landing.source(LOG)) == [("a", NOW, HOURLY)]  # b delivered nothing and stays pending
    assert [r[0] for r in loads.next_initial(landing, HOURLY, batch_size=10).collect()] == ["b"]
    landing.land(batch, HOURLY, now(), dedupe=False)
    assert landing.source(HOURLY).count() == 4


def test_an_empty_batch_and_logged_failures(spark, tmp_path):
    landing = landing_with(spark, tmp_path, station("a"))
    planned = loads.next_initial(landing, HOURLY)
    loads.land_and_log(landing, observations(spark).limit(0), HOURLY, planned, now(), log_failures=True)
    assert landing.source(HOURLY).count() == 0
    assert rows(landing.source(LOG)) == [("a", NOW, HOURLY)]


def test_increment_moves_bounds_on_every_snapshot(spark, tmp_path):
    landing = landing_with(spark, tmp_path, station("a"), station("a", taken="2024-01"), station("b"))
    planned = spark.createDataFrame([("a", NOW, NOW)], "station_id string, start timestamp_ntz, end timestamp_ntz")
    loads.land_increment(landing, observations(spark, ("a", NOW)), HOURLY, planned, now())
    assert rows(landing.source("land_obs_stations"), "id", "hourly_end", "daily_end") == [
        ("a", "2024-05-01T12:00:00+00:00", "2024-04-01T00:00:00+00:00"),
        ("a", "2024-05-01T12:00:00+00:00", "2024-04-01T00:00:00+00:00"),
        ("b", "2024-04-01T00:00:00+00:00", "2024-04-01T00:00:00+00:00"),
    ]
    assert rows(landing.source(LOG)) == [("a", NOW, HOURLY)]


def test_log_rows_are_replaced_per_table(spark):
    log = spark.createDataFrame([("a", NOW, HOURLY), ("a", NOW, DAILY), ("b", NOW, HOURLY)], LANDING[LOG])
    later = utc(NOW + dt.timedelta(days=1))
    ids = spark.createDataFrame([("a",), ("a",), ("c",)], "station_id string")
    assert rows(incremental.upsert_log(log, ids, HOURLY, later)) == [
        ("a", NOW, DAILY), ("a", NOW + dt.timedelta(days=1), HOURLY), ("b", NOW, HOURLY), ("c", NOW + dt.timedelta(days=1), HOURLY)
    ]


def test_versions_survive_a_rewrite_from_themselves(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "log"), LANDING[LOG])
    assert table.version() is None and table.read().count() == 0
    table.ensure()
    assert table.version() == 1 and table.read().count() == 0
    table.append(spark.createDataFrame([("a", NOW, HOURLY)], LANDING[LOG]))
    table.replace(table.read().unionByName(table.read()))
    assert table.version() == 3 and table.read().count() == 2
    partial = tmp_path / "log" / "version=4"
    spark.createDataFrame([("z", NOW, HOURLY)], LANDING[LOG]).write.parquet(str(partial))
    (partial / "_SUCCESS").unlink()
    assert table.version() == 3 and table.read().count() == 2  # what was not committed is not read
    table.replace(table.read())
    assert table.versions() == [1, 2, 3, 5] and table.read().count() == 2
    monkeypatch.setattr("obsloom.sources.versioned.KEPT_SECONDS", -60)
    table.replace(table.read())
    assert table.versions() == [5, 6] and table.read().count() == 2


def test_csv_keeps_leading_zeros_and_replaces(spark, tmp_path):
    path = tmp_path / "coord.csv"
    landing = Landing(spark, str(tmp_path / "lake"))
    header = "UACE,GEOID,GEOID_2,NAME,NAME_2,AREA_LAND,AREA_WATER,LATITUDE,LONGITUDE\n"
    for name in ("Old", '"Springfield, ""MA""--CT"'):
        path.write_text(header + f'00037,0,,{name},,5,6,1.5,-2.5\n')
        landing.load_csv(str(path), "land_city_coord", now())
    assert rows(landing.source("land_city_coord")) == [
        ("00037", "0", None, 'Springfield, "MA"--CT', None, 5, 6, 1.5, -2.5, "2024-05-01T12:00:00.000000+00:00")
    ]


def test_json_array_and_lines(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "lake"))
    record = {"id": "001", "name": "Zürich", "country": "CH", "latitude": 47.4, "hourly_start": "2024-01-01T00:00:00.000Z", "snapshot_time": "t1"}
    path = tmp_path / "stations.json"
    path.write_text(json.dumps([record, {**record, "id": "002"}], indent=2, ensure_ascii=False))
    landing.load_stations(str(path), array=True)
    files.write_json(landing.source("land_obs_stations").drop("snapshot_time"), str(tmp_path / "again"), F.lit("t2"))
    text = "".join(p.read_text() for p in (tmp_path / "again").glob("*.json"))
    assert "Zürich" in text and '"wmo":null' in text
    for _ in range(2):  # the second time nothing is new
        landing.load_stations(str(tmp_path / "again"))
    assert rows(landing.source("land_obs_stations"), "id", "snapshot_time") == [("001", "t1"), ("001", "t2"), ("002", "t1"), ("002", "t2")]


@pytest.mark.parametrize("array, text", [
    (True, '{"id": "1"}\n{"id": "2"}'), (True, '[{"id": "1"}]\n[{"id": "2"}]'), (True, '[{"id": "1"}, {"id"]'), (False, 'not json'), (False, '{"id": "1", "latitude": "x"}'),
])
def test_malformed_stations_are_set_aside(spark, tmp_path, array, text):
    (tmp_path / "s.json").write_text(text)
    landing = Landing(spark, str(tmp_path / "lake"))
    landing.load_stations(str(tmp_path / "s.json"), array)
    assert landing.source("land_obs_stations").count() == 0
    assert rows(spark.read.parquet(landing.path("land_obs_stations_malformed")), "record") == [(text,)]


def test_a_csv_of_malformed_rows_only_raises(spark, tmp_path):
    (tmp_path / "pop.csv").write_text('Rank,Geographic_Area,Population_In_2023\nx1,"York city, New York",5\n')
    with pytest.raises(Exception, match="malformed"):
        Landing(spark, str(tmp_path / "lake")).load_csv(str(tmp_path / "pop.csv"), "land_city_pop", now())


def test_landing_stores_each_station_and_time_once(spark, tmp_path):
    landing, later = Landing(spark, str(tmp_path / "lake")), NOW + dt.timedelta(hours=1)
    batch = observations(spark, ("a", NOW), ("a", NOW), (None, NOW), ("b", None), ("b", later))
    conflict = batch.withColumn("temp", F.when(F.col("station_id") == "b", 5.0).otherwise(F.col("temp")))
    for b in (batch.unionByName(batch.withColumn("temp", F.lit(-50.0))), batch, conflict):
        landing.land(b, HOURLY, now())
    assert rows(landing.source(HOURLY), "station_id", "time") == [("a", NOW), ("b", later)]
    assert spark.read.parquet(f"{tmp_path}/lake/{HOURLY}_rejected").select("station_id").distinct().count() == 2


def test_a_silent_station_does_not_block_the_others(spark, tmp_path):
    landing, planned = landing_with(spark, tmp_path, station("a"), station("b"), station("c")), []
    for day in range(4):
        plan = loads.next_initial(landing, HOURLY)
        planned += [r["station_id"] for r in plan.collect()]
        loads.land_and_log(landing, observations(spark).limit(0), HOURLY, plan, utc(NOW + dt.timedelta(days=day)))
    assert planned == ["a", "b", "c", "a"] and landing.source(LOG).count() == 0


def test_planning_an_increment_reads_marks_instead_of_facts(spark, tmp_path):
    landing = landing_with(spark, tmp_path, station("a"), station("b"))
    landing.land(observations(spark, ("a", NOW - dt.timedelta(days=90)), ("a", NOW - dt.timedelta(days=99))), HOURLY, now())
    landing.land(observations(spark, ("b", NOW - dt.timedelta(days=80)), (None, NOW)), HOURLY, now())
    plan = loads.next_incremental(landing, HOURLY, now())
    assert {r["station_id"]: r["start"] for r in plan.collect()} == {
        "a": NOW - dt.timedelta(days=90, hours=-1), "b": NOW - dt.timedelta(days=80, hours=-1)
    }
    files_read = plan.inputFiles()
    assert not any(f"/{HOURLY}/" in f for f in files_read) and any("land_obs_high_water" in f for f in files_read)


def deliver(tmp_path, name, *observed):
    folder = tmp_path / "delivered"
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"time": t, "temp": v, "station_id": s}) for s, t, v in observed]
    (folder / name).write_text("\n".join(lines))
    return str(folder)


def test_stream_landing_over_two_runs(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "lake"))

    def run(progress="progress"):
        stream_land(landing, str(tmp_path / "delivered"), HOURLY, str(tmp_path / progress), max_files=1).awaitTermination()

    deliver(tmp_path, "one.json", ("a", "2024-01-01 00:00:00", 1.0), ("b", "2024-01-01 01:00:00", 2.0))
    run()
    deliver(tmp_path, "two.json", ("a", "2024-01-01 01:00:00", 3.0))
    run()
    assert rows(landing.source(HOURLY), "station_id", "temp") == [("a", 1.0), ("a", 3.0), ("b", 2.0)]
    run("lost")  # all files again, without the stream's own progress
    assert landing.source(HOURLY).count() == 3
    assert rows(landing.source(LOG), "station_id", "table_name") == [("a", HOURLY), ("b", HOURLY)]


SPEC = [("lo", "min", "temp"), ("hi", "max", "temp"), ("total", "sum", "temp")]


def test_stream_rollup_drops_only_what_is_too_late(spark, tmp_path):
    schema = "time timestamp_ntz, temp double, station_id string"
    deliver(tmp_path, "one.json", ("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-02 10:00:00", 5.0))

    def run():
        stream = spark.readStream.schema(schema).json(str(tmp_path / "delivered"))
        rolled = stream_rollup(stream, key="station_id", time="time", date_as="obs_date", spec=SPEC, watermark="12 hours")
        write_updates(rolled, str(tmp_path / "updates"), str(tmp_path / "progress"), ["station_id", "obs_date"]).awaitTermination()
        return current_days(Updates(spark, str(tmp_path / "updates")).read(), "station_id", "obs_date")

    run()
    deliver(tmp_path, "two.json", ("a", "2024-01-02 12:00:00", 7.0), ("a", "2024-01-03 13:00:00", 9.0))
    got = run()
    batch = rollup.rollup_daily(
        spark.read.schema(schema).json(str(tmp_path / "delivered")), key="station_id", time="time", date_as="obs_date", spec=SPEC
    )
    assert rows(got) == rows(batch)
    deliver(tmp_path, "three.json", ("a", "2024-01-01 11:00:00", 99.0), ("a", "2024-01-03 14:00:00", 10.0))
    late = {r["obs_date"].day: r["hi"] for r in run().collect()}
    assert late == {1: 1.0, 2: 7.0, 3: 10.0}


def test_closed_days_are_written_once(spark, tmp_path):
    schema = "time timestamp_ntz, temp double, station_id string"

    def run():
        stream = spark.readStream.schema(schema).json(str(tmp_path / "delivered"))
        rolled = stream_rollup(stream, key="station_id", time="time", date_as="obs_date", spec=SPEC, watermark="12 hours")
        write_closed(rolled, str(tmp_path / "days"), str(tmp_path / "progress")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "days")), "obs_date", "total")

    deliver(tmp_path, "one.json", ("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-02 10:00:00", 5.0))
    assert run() == []
    deliver(tmp_path, "two.json", ("a", "2024-01-01 23:00:00", 2.0), ("a", "2024-01-02 12:30:00", 7.0))
    assert run() == [(dt.date(2024, 1, 1), 3.0)]
    deliver(tmp_path, "three.json", ("a", "2024-01-03 13:00:00", 9.0))
    assert run() == [(dt.date(2024, 1, 1), 3.0), (dt.date(2024, 1, 2), 12.0)]


def test_build_all_writes_every_table(spark, tmp_path):
    landing = landing_with(spark, tmp_path, station("a"), station("b"))
    landing.land(observations(spark, ("a", dt.datetime(2024, 1, 1, 3)), ("a", dt.datetime(2024, 1, 4, 3))), HOURLY, now())
    daily = observations(spark, ("a", dt.datetime(2024, 1, 1))).select("time", "station_id", F.lit(2.0).alias("tavg"))
    missing = [F.lit(None).cast("double").alias(c) for c in LANDING[DAILY].names if c not in ("time", "tavg", "station_id", "load_time")]
    landing.land(daily.select("*", *missing), DAILY, now())
    coord = spark.createDataFrame([("1", "1", "1", "York, NY", "York", 1, 1, 40.1, -70.0, "t")], LANDING["land_city_coord"])
    pop = spark.createDataFrame([(1, "York city, New York", "1,000", "t")], LANDING["land_city_pop"])
    landing.small("land_city_coord").replace(coord)
    landing.small("land_city_pop").replace(pop)
    stored = build_all(Warehouse(landing.source, calendar_end=dt.date(2024, 2, 1)), str(tmp_path / "marts")).snapshot()
    counts = {name: stored.read(name).count() for name in stored.tables if not name.startswith("_")}
    assert counts == {
        "mart_date_dim": 31, "mart_hour_dim": 23, "mart_obs_fact": 2, "mart_obs_window_fact": 2, "mart_stations_dim": 2,
        "mart_city_dim": 1, "mart_city_station_bridge": 2, "mart_station_obs_qc_obt": 1, "obs_fact": 2, "obs_fact_cp": 2,
        "mart_obs_fact_unpiv": 28, "mart_station_obs_obt": 2,
    }


def test_declared_checks_find_what_is_wrong(spark):
    from obsloom.plans.checks import run_checks
    from obsloom.plans.tested import NOT_NULL, RELATIONSHIPS, UNIQUE

    columns = {m: sorted({*UNIQUE.get(m, []), *NOT_NULL.get(m, [])}) for m in {*UNIQUE, *NOT_NULL}}
    columns["mart_city_station_bridge"].append("city_dim_id")
    bad = {"mart_city_dim": [("x",), ("x",), (None,)], "mart_city_station_bridge": [("a", None, "x"), ("b", "s", "gone"), ("c", "s", None)]}

    def table(name):
        names = columns[name]
        return spark.createDataFrame(bad.get(name, [tuple("v" for _ in names)]), ", ".join(f"{c} string" for c in names))

    columns["mart_city_station_bridge"] = ["station_city_match_id", "station_id", "city_dim_id"]
    results = run_checks(table).collect()
    assert len(results) == 35 and len(RELATIONSHIPS) == 1
    assert sorted((r["model"], r["column_name"], r["test"], r["failures"]) for r in results if r["failures"]) == [
        ("mart_city_dim", "city_coord_pop_id", "not_null", 1),
        ("mart_city_dim", "city_coord_pop_id", "unique", 1),
        ("mart_city_station_bridge", "city_dim_id", "relationships", 1),
        ("mart_city_station_bridge", "station_id", "not_null", 1),
    ]
