"""Published versions, rebuilding what changed, logs of changes, merged runs and records set aside."""

from __future__ import annotations

import datetime as dt
import json
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_loading import DAILY, HOURLY, LOG, NOW, landing_with, now, observations, station

from obsloom.operators.incremental import log_rows
from obsloom.plans.checks import declared, differences, run_checks
from obsloom.plans.refresh import beside, refresh
from obsloom.plans.tested import NOT_NULL, UNIQUE
from obsloom.plans.warehouse import ARCHIVE, BY_MONTH, MARTS, SERVE, Warehouse
from obsloom.sources import files
from obsloom.sources.keyed import KeyedLog
from obsloom.sources.landing import Landing
from obsloom.sources.published import ConcurrentBuild, Published
from obsloom.sources.schemas import LANDING
from obsloom.sources.snapshots import SnapshotTable
from obsloom.sources.storage import CommitLog, Storage
from obsloom.sources.versioned import VersionedTable
from obsloom.streaming.rollup import Updates, current_days


def days(spark, *dates, n=1):
    return spark.createDataFrame([(f"s{i}", dt.date.fromisoformat(d), float(i)) for d in dates for i in range(n)], "station_id string, obs_date date, v double")


# Files that only one writer creates.


def test_a_number_is_given_once(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/a log")
    assert log.newest() == 0
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.add(1, {"writer": i}), range(8)))
        assert sum(won) == 1 and log.read(1) == {"writer": won.index(True)}
        assert sorted(pool.map(lambda i: log.append({"i": i}), range(8))) == list(range(2, 10))
    assert {log.read(n)["i"] for n in range(2, 10)} == set(range(8))
    assert Storage(spark).names(f"{tmp_path}/a log") and not [n for n in Storage(spark).names(f"{tmp_path}/a log") if not n.endswith(".json")]


# Published versions.


def publish(published, df, **how):
    build = published.build()
    build.store(df, "fact", "obs_date", **how)
    return build.commit()


def test_readers_see_whole_versions(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    publish(published, days(spark, "2024-01-05", "2024-02-07"))
    build = published.build()
    build.store(days(spark, "2024-03-01"), "fact", "obs_date")
    build.store(days(spark, "2024-03-01"), "dim")
    # Stored but not committed: nobody sees any of it, also if this build is never finished.
    assert rows(published.read("fact"), "obs_date") == [(dt.date(2024, 1, 5),), (dt.date(2024, 2, 7),)]
    assert "dim" not in published.snapshot() and build.read("dim").count() == 1
    kept = published.snapshot()
    build.commit()
    assert rows(published.read("fact"), "obs_date") == [(dt.date(2024, 3, 1),)] and published.read("dim").count() == 1
    assert kept.read("fact").count() == 2 and published.snapshot(1).read("fact").count() == 2


def test_dates_choose_files(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    publish(published, days(spark, *[f"2024-{m:02d}-{d}" for m in range(1, 13) for d in (10, 20)], n=3), order=["station_id"])
    some = published.read("fact", since=dt.date(2024, 3, 15), until=dt.date(2024, 5, 10))
    assert {f.split("obs_month=")[1][:7] for f in some.inputFiles()} == {"2024-03", "2024-04", "2024-05"}
    assert some.count() == 3 * 4 and some.columns == ["station_id", "obs_date", "v"]
    assert published.read("fact", since=dt.date(2025, 1, 1)).count() == 0


def test_some_months_are_replaced(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    publish(published, days(spark, "2024-01-05", "2024-02-07", "2024-03-03"))
    before = published.snapshot()
    after = publish(published, days(spark, "2024-02-08", "2024-02-09"), months={"2024-02", "2024-03"})
    assert rows(published.read("fact"), "obs_date") == [(dt.date(2024, 1, 5),), (dt.date(2024, 2, 8),), (dt.date(2024, 2, 9),)]
    assert before.read("fact", months=["2024-01"]).inputFiles() == after.read("fact", months=["2024-01"]).inputFiles()
    assert before.read("fact").count() == 3 and after.months("fact") == ["2024-01", "2024-02"]


def test_builds_at_the_same_time(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    publish(published, days(spark, "2024-01-05"))
    one, two, part = published.build(), published.build(), published.build()
    one.store(days(spark, "2024-01-06"), "fact", "obs_date")
    two.store(days(spark, "2024-01-07"), "dim")
    part.store(days(spark, "2024-01-08"), "fact", "obs_date", months={"2024-01"})
    one.commit()
    two.commit()  # goes over the version of the first, and keeps its other table
    assert rows(published.read("fact"), "obs_date") == [(dt.date(2024, 1, 6),)] and published.read("dim").count() == 1
    with pytest.raises(ConcurrentBuild):
        part.commit()
    assert published.snapshot().number == 3


def test_old_versions_are_let_go(spark, tmp_path, monkeypatch):
    published = Published(spark, str(tmp_path))
    publish(published, days(spark, "2024-01-05", "2024-02-07"))
    publish(published, days(spark, "2024-02-08"), months={"2024-02"})
    assert published.vacuum() == []
    monkeypatch.setattr("obsloom.sources.published.KEPT_SECONDS", -60)
    gone = published.vacuum()
    assert len(gone) == 1 and gone[0].endswith("obs_month=2024-02")
    assert published.manifests.numbers() == [2] and rows(published.read("fact"), "obs_date") == [(dt.date(2024, 1, 5),), (dt.date(2024, 2, 8),)]


# Rebuilding what changed.


def landed(spark, tmp_path, *dates):
    landing = landing_with(spark, tmp_path, station("a"), station("b"))
    land_days(spark, landing, *dates)
    landing.small("land_city_coord").replace(spark.createDataFrame([("1", "1", "1", "York, NY", "York", 1, 1, 40.1, -70.0, "t")], LANDING["land_city_coord"]))
    landing.small("land_city_pop").replace(spark.createDataFrame([(1, "York city, New York", "1,000", "t")], LANDING["land_city_pop"]))
    return landing


def land_days(spark, landing, *dates):
    times = [dt.datetime.fromisoformat(d) for d in dates]
    landing.land(observations(spark, *[(s, t + dt.timedelta(hours=3)) for t in times for s in "ab"]), HOURLY, now())
    missing = [F.lit(None).cast("double").alias(c) for c in LANDING[DAILY].names if c not in ("time", "tavg", "station_id", "load_time")]
    daily = observations(spark, *[("a", t) for t in times]).select("time", "station_id", F.dayofmonth("time").cast("double").alias("tavg"))
    landing.land(daily.select("*", *missing), DAILY, now())


END = dt.date(2024, 6, 1)


def test_refresh_equals_a_full_build(spark, tmp_path):
    landing = landed(spark, tmp_path, "2024-01-15", "2024-01-31", "2024-02-10", "2024-03-30", "2024-05-05")
    marts, names = str(tmp_path / "marts"), (*MARTS, *SERVE, *ARCHIVE)

    def same_as_full(published):
        full = refresh(landing, str(tmp_path / f"full{published.snapshot().number}"), END)
        for name in names:
            assert rows(published.read(name)) == rows(full.read(name)), name
            assert published.snapshot().schema(name) == full.snapshot().schema(name)

    first = refresh(landing, marts, END).snapshot()
    assert refresh(landing, marts, END).snapshot().number == first.number  # nothing landed, nothing published
    land_days(spark, landing, "2024-02-01", "2024-02-10", "2024-04-02")  # beside the end of a month, a repeat, and a new month
    published = refresh(landing, marts, END)
    second = published.snapshot()
    assert second.number == first.number + 1
    same_as_full(published)
    for name in BY_MONTH:
        old, new = first.tables[name]["parts"], second.tables[name]["parts"]
        untouched = {"2024-01", "2024-03", "2024-05"} if name != "mart_obs_window_fact" else set()
        assert {m for m in old if new[m] == old[m]} == untouched, name  # the windows' neighbours of February and April are all months
    assert second.tables["mart_city_dim"] == first.tables["mart_city_dim"]
    # Stations alone: their attributes and what carries them, no fact.
    landing.small("land_obs_stations").append(spark.createDataFrame([station("a", region="TX", taken="2024-03")], LANDING["land_obs_stations"]))
    published = refresh(landing, marts, END)
    third = published.snapshot()
    same_as_full(published)
    assert third.tables["mart_obs_fact"] == second.tables["mart_obs_fact"] and third.tables["mart_station_obs_obt"] != second.tables["mart_station_obs_obt"]
    assert beside({"2024-01", "2024-12"}) == {"2023-12", "2024-01", "2024-02", "2024-11", "2024-12", "2025-01"}


def test_only_dirty_months_are_read(spark, tmp_path):
    landing = landed(spark, tmp_path, "2024-01-15", "2024-02-10")
    before = landing.fingerprints()
    land_days(spark, landing, "2024-02-11")
    after = landing.fingerprints()
    assert {m for m in after[HOURLY] if after[HOURLY][m] != before[HOURLY].get(m)} == {"2024-02"}
    plan = landing.source(HOURLY, ["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*obs_month", plan)


def test_stored_marts_must_be_the_declared_ones(spark, tmp_path):
    landing = landed(spark, tmp_path, "2024-01-15")
    schemas = declared(spark)
    published = refresh(landing, str(tmp_path / "marts"), END)
    assert differences(published.snapshot(), schemas) == []
    build = published.build()
    build.store(published.read("mart_stations_dim").drop("wmo").withColumn("elevation", F.lit("high")).withColumn("n", F.lit(1)), "mart_stations_dim")
    build.commit()
    found = differences(published.snapshot(), schemas)
    assert any("column n is int" in d for d in found) and any("elevation is string" in d for d in found)
    assert differences(Published(spark, str(tmp_path / "none")).snapshot(), schemas) == [f"{m}: missing" for m in MARTS]


# Logs of changes.


def log_of(spark, path, **how):
    return KeyedLog(spark, path, LANDING[LOG], ["station_id", "table_name"], **how)


def loaded(spark, day, *stations):
    return log_rows(spark.createDataFrame([(s,) for s in stations], "station_id string"), HOURLY, F.lit(NOW + dt.timedelta(days=day)).cast("timestamp_ntz"))


def test_the_latest_change_of_a_key_counts(spark, tmp_path):
    log = log_of(spark, str(tmp_path / "log"), fan_in=3)
    assert log.version() is None and log.read().count() == 0
    for day in range(9):
        log.append(loaded(spark, day, "a", f"s{day % 2}"))
        assert len(log.folders()) <= 3
        assert {r["station_id"]: (r["last_fetched"] - NOW).days for r in log.read().collect()} == {"a": day, f"s{day % 2}": day, **({f"s{1 - day % 2}": day - 1} if day else {})}
    log.append(loaded(spark, 0, "a"))  # an earlier time, but a later change
    assert rows(log.read().where("station_id = 'a'"), "last_fetched") == [(NOW,)]
    log.replace(loaded(spark, 1, "z"))
    assert rows(log.read(), "station_id") == [("z",)]
    highest = log_of(spark, str(tmp_path / "marks"), newest="last_fetched", fan_in=2)
    for day in (3, 1, 2, 0):
        highest.append(loaded(spark, day, "a"))
    assert rows(highest.read(), "last_fetched") == [(NOW + dt.timedelta(days=3),)]


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: log_of(spark, str(tmp_path), fan_in=4).append(loaded(spark, i, f"s{i}", "shared")), range(12)))
    assert rows(log_of(spark, str(tmp_path)).read(), "station_id") == sorted([*[(f"s{i}",) for i in range(12)], ("shared",)])


def test_a_stopped_change_is_not_read_and_old_folders_go(spark, tmp_path, monkeypatch):
    log = log_of(spark, str(tmp_path), fan_in=2)
    log._written(loaded(spark, 0, "lost"))  # rows without their record
    for day in range(4):
        log.append(loaded(spark, day, "a"))
    assert rows(log.read(), "station_id") == [("a",)]
    monkeypatch.setattr("obsloom.sources.keyed.KEPT_SECONDS", -60)
    for day in range(4, 8):
        log.append(loaded(spark, day, "a"))
    assert len(log.changes.numbers()) <= 3 and len(log.snapshots.numbers()) == 1
    assert rows(log.read(), "last_fetched") == [(NOW + dt.timedelta(days=7),)]


def test_a_version_has_one_writer(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), LANDING[LOG])
    table.ensure()
    other = VersionedTable(spark, str(tmp_path / "t"), LANDING[LOG])
    monkeypatch.setattr(other.claims, "newest", lambda: 1)  # both look before either writes
    table.claims.add(2, {})
    with pytest.raises(FileExistsError):
        other.replace(loaded(spark, 0, "b"))
    assert not (tmp_path / "t" / "version=2").exists()
    table.replace(loaded(spark, 0, "a"))  # a number that was reserved and not used is left out
    assert table.versions() == [1, 3] and rows(table.read(), "station_id") == [("a",)]


# Runs of updates.


def test_fifty_micro_batches_are_few_runs(spark, tmp_path):
    updates = Updates(spark, str(tmp_path), fan_in=4)
    for batch in range(50):
        changed = spark.createDataFrame([("a", dt.date(2024, 1, 1), float(batch)), (f"k{batch % 7}", dt.date(2024, 1, 2), float(batch))], "station_id string, obs_date date, v double")
        updates.add(changed, batch, ["station_id", "obs_date"])
    updates.add(changed, 49, ["station_id", "obs_date"])  # a repeated batch
    assert len(updates.runs()) <= 9 and len({f.rsplit("/", 2)[1] for f in updates.read().inputFiles()}) <= 9
    newest = {r["station_id"]: r["v"] for r in current_days(updates.read(), "station_id", "obs_date").collect()}
    assert newest == {"a": 49.0, **{f"k{i}": float(max(b for b in range(50) if b % 7 == i)) for i in range(7)}}
    assert len(Storage(spark).names(str(tmp_path))) == len(updates.runs()) + 1
    plan = current_days(updates.read(), "station_id", "obs_date")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


# Records that cannot be read.


def test_malformed_stations_do_not_stop_the_others(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "lake"))
    good = [{"id": "1", "name": "Pier [A] [B] \"{", "snapshot_time": "t"}, {"id": "2", "name": "]\n[", "snapshot_time": "t"}]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(g) for g in good) + '\nnot json\n{"id": "3", "latitude": "x", "snapshot_time": "t"}\nnot json\n')
    for _ in range(2):
        landing.load_stations(str(tmp_path / "lines.json"))
    assert rows(landing.source("land_obs_stations"), "id", "name") == [("1", good[0]["name"]), ("2", good[1]["name"])]
    aside = spark.read.parquet(landing.path("land_obs_stations_malformed"))
    assert rows(aside, "record", "times") == [("not json", 2), ('{"id": "3", "latitude": "x", "snapshot_time": "t"}', 1)]
    assert all(r["file"].endswith("lines.json") for r in aside.collect())


@pytest.mark.parametrize(
    "text, good, bad",
    [
        ('[{"id": "1", "name": "Pier [A] [B]"}, {"id": "2"}]', ["1", "2"], 0), (' \n[]\n', [], 0), ('[{"id": "1"}, {"id": "2", "latitude": "x"}, 5, {}]', ["1", None], 2),
        ('{"id": "1"}\n{"id": "2"}', [], 1), ('[{"id": "1"}]\n[{"id": "2"}]', [], 1), ('[{"id": "1"}] {"id": "2"} []', [], 1), ('[{"id": "1"}, {"id"]', [], 1), ("", [], 0),
    ],
)
def test_arrays(spark, tmp_path, text, good, bad):
    (tmp_path / "a.json").write_text(text)
    read = files.read_delivered(spark, str(tmp_path / "a.json"), LANDING["land_obs_stations"], "json", array=True)
    found = read.select("id", files.RECORD).collect()
    assert [r["id"] for r in found if r[files.RECORD] is None] == good and sum(r[files.RECORD] is not None for r in found) == bad


def test_csv_rows_that_cannot_be_read(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "lake"))
    header = "Rank,Geographic_Area,Population_In_2023\n"
    (tmp_path / "pop.csv").write_text(header + '1,"York city, New York",5\nx1,Rome,5\n')
    landing.load_csv(str(tmp_path / "pop.csv"), "land_city_pop", now())
    assert rows(landing.source("land_city_pop"), "Rank") == [(1,)]
    assert rows(spark.read.parquet(landing.path("land_city_pop_malformed")), "record", "times") == [("x1,Rome,5", 1)]
    (tmp_path / "pop.csv").write_text(header + "x1,Rome,5\n")
    with pytest.raises(ValueError, match="malformed"):  # another format: the stored table stays
        landing.load_csv(str(tmp_path / "pop.csv"), "land_city_pop", now())
    (tmp_path / "pop.csv").write_text("Area,Rank,Population\n1,2,3\n")
    with pytest.raises(Exception, match="header|HEADER"):
        landing.load_csv(str(tmp_path / "pop.csv"), "land_city_pop", now())
    assert rows(landing.source("land_city_pop"), "Rank") == [(1,)]


def test_rejected_rows_are_kept_once(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "lake"))
    batch = observations(spark, (None, NOW), ("a", None), ("a", NOW))
    for hour in range(4):
        landing.land(batch, HOURLY, F.lit(NOW + dt.timedelta(hours=hour)))
    assert rows(spark.read.parquet(landing.path(f"{HOURLY}_rejected")), "station_id", "time") == [("a", None), (None, NOW)]
    assert landing.source(HOURLY).count() == 1


def copy_rows(spark, *rows_):
    return spark.createDataFrame(list(rows_), "id int, taken string, name string")


def test_a_copy_is_stored_and_read_alone(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), copy_rows(spark, (1, "x", "y")).schema, "taken")
    assert table.version() is None and table.newest().count() == 0 and table.read().count() == 0
    table.append(copy_rows(spark, (1, None, "null"), (2, "", "empty")))
    assert rows(table.newest(), "id") == [(2,)]
    table.append(copy_rows(spark, (1, "2024-01-01T00:00:00+00:00", "a"), (2, "2024-01-01T00:00:00+00:00", "b")))
    before = set(table.read().inputFiles())
    table.append(copy_rows(spark, (1, "2024-02-01T00:00:00+00:00", "c")))
    table.append(copy_rows(spark, (2, "2024-02-01T00:00:00+00:00", "d"), (9, "2024-01-01T00:00:00+00:00", "late")))
    table.append(copy_rows(spark).limit(0))
    assert before < set(table.read().inputFiles())  # copies stored before are not written again
    newest = table.newest()
    assert rows(newest, "id", "name") == [(1, "c"), (2, "d")]
    assert all("2024-02-01" in f for f in newest.inputFiles()) and len(newest.inputFiles()) == 2
    assert rows(table.read().where("taken is not null"), "id", "name") == [(1, "a"), (1, "c"), (2, "b"), (2, "d"), (2, "empty"), (9, "late")]
    assert table.copies() == ["2024-01-01T00:00:00+00:00", "2024-02-01T00:00:00+00:00"]
    version, moved = table.version(), table.read().withColumn("name", F.upper("name"))
    table.append(copy_rows(spark, (3, "2024-03-01", "e")))
    with pytest.raises(FileExistsError):  # the rows were made from a version without the newest copy
        table.replace(moved, after=version)
    table.replace(table.read().withColumn("name", F.upper("name")), after=table.version())
    assert rows(table.newest(), "id", "name") == [(3, "E")]


def test_stations_of_the_older_form_are_taken_over(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "lake"))
    old = VersionedTable(spark, landing.path("land_obs_stations"), LANDING["land_obs_stations"])
    old.append(spark.createDataFrame([station("a", taken="2024-01"), station("a", taken="2024-02")], LANDING["land_obs_stations"]))
    assert rows(landing.newest_stations(), "id", "snapshot_time") == [("a", "2024-02")]
    assert landing.source("land_obs_stations").count() == 2 and landing.small("land_obs_stations").version() == 1


def test_nulls_are_counted_as_they_are_written(spark, tmp_path):
    published = Published(spark, str(tmp_path / "p"))

    def valued(*values):
        return spark.createDataFrame([(dt.date.fromisoformat(d), v) for d, v in values], "day date, v int")

    build = published.build()
    build.store(valued(("2024-01-01", 1), ("2024-01-02", None), ("2024-02-01", 2)), "t", "day", not_null=["day", "v"])
    build.store(valued(), "none", "day", not_null=["v"])
    build.store(valued(("2024-01-01", None)), "plain", not_null=["v"])
    build.commit()
    stored = published.snapshot()
    assert [stored.nulls("t", c) for c in ("day", "v", "other")] == [0, 1, None]
    assert (stored.nulls("none", "v"), stored.nulls("plain", "v"), stored.nulls("gone", "v")) == (0, 1, None)
    build = published.build()
    build.store(valued(("2024-02-01", None), ("2024-02-02", None)), "t", "day", ["2024-02"], not_null=["day", "v"])
    build.commit()
    stored = published.snapshot()
    assert stored.nulls("day", "t") is None and stored.nulls("t", "day") == 0
    assert stored.nulls("t", "v") is None  # which month the first write's null was in is not known
    build = published.build()
    build.store(valued(("2024-01-05", 5)), "t", "day", ["2024-01"], not_null=["day", "v"])
    build.commit()
    assert published.snapshot().nulls("t", "v") == 2 and set(published.snapshot().tables["t"]["nulls"]) == {
        f.split("/")[1] for f in published.snapshot().tables["t"]["parts"].values()
    }


def test_checks_of_stored_marts_scan_keys_only(spark, tmp_path):
    landing = landed(spark, tmp_path, "2024-01-15", "2024-02-10")
    stored = refresh(landing, str(tmp_path / "marts"), END).snapshot()
    warehouse = Warehouse(landing.source, END)
    scans = []

    def table(name):
        scans.append(name)
        return stored.read(name) if name in stored else getattr(warehouse, name)

    counted = run_checks(table, stored.nulls)
    names = [n for n in scans if n in MARTS]
    assert sorted(names) == sorted([m for m in MARTS if m in UNIQUE] + ["mart_city_station_bridge", "mart_city_dim"])  # the last two for the relationship
    assert "mart_obs_fact" not in names
    scans.clear()
    assert rows(counted) == rows(run_checks(table)) and len(scans) == len({*UNIQUE, *NOT_NULL}) + 2


def test_keys_are_stored_at_half_their_digits(spark, tmp_path):
    """Digits of hashes hold half a byte each."""
    build = Published(spark, str(tmp_path / "p")).build()
    own = spark.range(50_000, numPartitions=1).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = build.store(own, "bridge")
    stored = sum(f.stat().st_size for f in (tmp_path / "p").rglob("*.parquet"))
    assert got.exceptAll(own).isEmpty() and got.count() == 50_000 and stored < 50_000 * 20  # 36 bytes a row as they are
