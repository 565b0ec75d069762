"""Publishing the marts again after something has landed, by rebuilding what that changes.

The manifest of a build keeps what it was made from: for every month of observations the number and
bytes of the landed files, for the small tables their version. A month that differs now is dirty. The
merge and the facts are computed for dirty months alone, from those months' files; the window fact
also for the months beside them, since a window reaches into the next month. What counts or compares
all days (station counts, scorecards) is computed from the stored merge. The other months' files stay.
"""

from __future__ import annotations

import datetime as dt

from obsloom.plans.warehouse import ARCHIVE, BY_MONTH, MARTS, SERVE, SHARED, Warehouse, build_all, over, store_all, store_shared, stored_warehouse
from obsloom.sources.landing import FACTS, Landing
from obsloom.sources.published import Published, month_of

#: What each input's change makes new, besides the facts of dirty months.
FROM_OBSERVATIONS = ("mart_date_dim", "mart_stations_dim", "mart_station_obs_qc_obt")
FROM_STATIONS = ("mart_stations_dim", "mart_city_station_bridge", "mart_station_obs_qc_obt", "mart_station_obs_obt")
FROM_CITIES = ("mart_city_dim", "mart_city_station_bridge")


def changed(now: dict[str, str], before: dict[str, str]) -> set[str]:
    """Keys of which the values differ, or that only one has."""
    return {k for k in {*now, *before} if now.get(k) != before.get(k)}


def beside(months: set[str]) -> set[str]:
    """Months with those before and after them."""
    out = set()
    for month in months:
        first = dt.date.fromisoformat(f"{month}-01")
        out |= {month, f"{first - dt.timedelta(days=1):%Y-%m}", f"{first + dt.timedelta(days=31):%Y-%m}"}
    return out


def refresh(landing: Landing, directory: str, calendar_end=None, names=(*MARTS, *SERVE, *ARCHIVE), full: bool = False) -> Published:
    """Bring the published tables up to what has landed; publishes nothing if nothing has changed.

    All is built if nothing was published by ``refresh`` before, or with ``full``.
    """
    # Looked at before the tables are read: what lands meanwhile counts as changed the next time.
    inputs = {**landing.fingerprints(), "calendar_end": {"": str(calendar_end)}}
    warehouse = Warehouse(landing.source, calendar_end, landing.newest_stations)
    published = Published(landing.spark, directory)
    build = published.build()
    before = build.base.inputs
    if full or not before or any(name not in build.base for name in (*names, *SHARED.values())):
        return build_all(warehouse, directory, names, inputs)
    dirty = set().union(*(changed(inputs[t], before.get(t, {})) for t in FACTS))
    stations = changed(inputs["land_obs_stations"], before["land_obs_stations"])
    cities = changed(inputs["land_city_coord"], before["land_city_coord"]) | changed(inputs["land_city_pop"], before["land_city_pop"])
    calendar = changed(inputs["calendar_end"], before["calendar_end"])
    if not (dirty or stations or cities or calendar):
        return published

    if stations:
        store_shared(build, warehouse, ["stg_obs_stations"])
    if cities:
        store_shared(build, warehouse, ["stg_city_pop"])
        store_shared(build, over(warehouse, stg_city_pop=build.read("_city_pop")), ["city_coord_and_pop"])
    if dirty:
        store_shared(build, Warehouse(lambda name: landing.source(name, dirty if name in FACTS else None), calendar_end), ["_obs_daily_all_qc"], dirty)

    whole = {
        *(FROM_OBSERVATIONS if dirty else ()), *(FROM_STATIONS if stations else ()), *(FROM_CITIES if cities else ()),
        *(["mart_date_dim"] if calendar else ()),
    }
    all_days = stored_warehouse(build, warehouse)
    frames = {name: getattr(all_days, name) for name in names if name in whole}
    months = {}
    if dirty:
        windows = beside(dirty)
        dirty_days = stored_warehouse(build, warehouse, dirty)
        for name in (n for n in names if n in BY_MONTH and n not in whole):
            months[name] = windows if name == "mart_obs_window_fact" else dirty
            # The windows of these months take days from the months beside them; their anchors there are left out.
            around = stored_warehouse(build, warehouse, beside(windows)) if name == "mart_obs_window_fact" else dirty_days
            frames[name] = in_months(getattr(around, name), BY_MONTH[name], months[name])
    store_all(build, frames, months)
    build.commit(inputs)
    return published


def in_months(df, date: str, months: set[str]):
    """Rows whose date lies in one of the months."""
    return df.where(month_of(date).isin(sorted(months)))
