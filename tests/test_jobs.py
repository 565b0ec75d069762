"""The jobs one after another, from delivered files to checked marts."""

from __future__ import annotations

import json

import pytest
from conftest import rows

from obsloom.jobs import run
from obsloom.sources.landing import Landing
from obsloom.sources.published import Published


def station(id_, **changed):
    bounds = {f"{k}_{e}": t for k in ("hourly", "daily") for e, t in (("start", "2024-01-01T00:00:00.000Z"), ("end", "2024-03-01T00:00:00.000Z"))}
    return {"id": id_, "name": f"Station {id_}", "country": "US", "region": "NY", "latitude": 40.0, "longitude": -70.0, **bounds,
            "snapshot_time": "2024-02-01T00:00:00+00:00", **changed}


def test_from_files_to_marts(spark, tmp_path):
    lake, marts, plan = str(tmp_path / "lake"), str(tmp_path / "marts"), str(tmp_path / "plan")

    def job(command, *more):
        return run(spark, [command, "--landing", lake, "--now", "2024-02-10T00:00:00", *map(str, more)])

    (tmp_path / "stations.json").write_text(json.dumps([station("1"), station("2"), station("3", country="CA")]))
    (tmp_path / "coord.csv").write_text(
        "UACE,GEOID,GEOID_2,NAME,NAME_2,AREA_LAND,AREA_WATER,LATITUDE,LONGITUDE\n007,1,1,\"York, NY\",York,1,1,40.1,-70.1\n"
    )
    (tmp_path / "pop.csv").write_text('Rank,Geographic_Area,Population_In_2023\n1,"York city, New York","1,234"\n2,"Rome city, Georgia",5\n')
    for _ in range(2):  # the second run adds nothing
        job("load-stations", "--json", tmp_path / "stations.json", "--array")
    assert Landing(spark, lake).source("land_obs_stations").count() == 3
    job("load-cities", "--coord", tmp_path / "coord.csv", "--pop", tmp_path / "pop.csv")

    def deliver(name, *observed):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.json").write_text("\n".join(json.dumps(o) for o in observed))
        return tmp_path / name

    daily = [{"time": f"2024-01-0{d} 00:00:00", "tavg": 1.0 * d, "station_id": "1"} for d in (1, 2, 4)]
    job("plan", "--table", "land_obs_daily", "--plan", plan, "--batch-size", 5)
    assert rows(spark.read.parquet(plan), "station_id") == [("1",), ("2",)]
    job("land", "--table", "land_obs_daily", "--plan", plan, "--files", deliver("daily", *daily), "--format", "json")

    hourly = [{"time": f"2024-01-0{d} 0{h}:00:00", "temp": 1.0 * h, "station_id": "1"} for d in (1, 3) for h in (1, 2)]
    job("stream", "--table", "land_obs_hourly", "--progress", tmp_path / "progress", "--files", deliver("hourly", *hourly), "--format", "json")
    job("plan", "--table", "land_obs_hourly", "--plan", plan, "--incremental")
    assert [tuple(map(str, r)) for r in spark.read.parquet(plan).orderBy("station_id").collect()] == [
        ("1", "2024-01-03 03:00:00", "2024-02-10 00:00:00"), ("2", "2024-01-01 00:00:00", "2024-02-10 00:00:00")
    ]
    more = deliver("more", {"time": "2024-01-05 01:00:00", "temp": 3.0, "station_id": "1"})
    job("land", "--table", "land_obs_hourly", "--plan", plan, "--incremental", "--files", more, "--format", "json")
    assert rows(Landing(spark, lake).source("land_obs_load_log"), "station_id", "table_name") == [
        ("1", "land_obs_daily"), ("1", "land_obs_hourly"), ("2", "land_obs_hourly")
    ]

    job("build", "--out", marts, "--calendar-end", "2024-02-01")

    def mart(name):
        return Published(spark, marts).read(name)

    assert rows(mart("mart_obs_fact"), "station_id", "obs_date").__len__() == 5
    assert rows(mart("mart_city_dim"), "area_code", "population") == [("007", 1234)]
    assert mart("mart_city_station_bridge").count() == 3
    assert mart("mart_stations_dim").filter("station_id = '1'").first()["tmax_f_count"] == 3
    assert mart("mart_date_dim").count() == 31
    assert len(job("check", "--marts", marts)) == 35

    job("land", "--table", "land_obs_daily", "--plan", plan, "--files", deliver("null", {"tavg": 1.0, "station_id": "1"}), "--format", "json")
    assert len(job("check", "--marts", marts)) == 35
    assert rows(spark.read.parquet(f"{lake}/land_obs_daily_rejected"), "station_id", "tavg") == [("1", 1.0)]

    def publish(name, df):
        build = Published(spark, marts).build()
        build.store(df, name)
        build.commit()

    stations = mart("mart_stations_dim")
    publish("mart_stations_dim", spark.createDataFrame([("1", 1)], "station_id string, n int"))
    with pytest.raises(SystemExit, match="mart_stations_dim: column n is int, declared not at all"):
        job("check", "--marts", marts)
    publish("mart_stations_dim", stations.unionByName(stations))
    with pytest.raises(SystemExit, match="mart_stations_dim.station_id unique: 3$"):
        job("check", "--marts", marts)
    publish("mart_stations_dim", stations)
    assert len(job("check", "--marts", marts)) == 35
