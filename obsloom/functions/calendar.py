"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_of_month(date) -> Column:
    """Weeks counted from the first of the month, as double."""
    return F.floor((F.day(_col(date)) - 1) / F.lit(7)).cast("double") + F.lit(1.0)


def weekday_from_sunday(date) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(_col(date)) - 1).cast("bigint")


def date_parts(date) -> dict[str, Column]:
    """The calendar columns of one date, in output order."""
    d = _col(date)
    return {
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day_of_month": F.day(d).cast("bigint"),
        "week_of_month": week_of_month(d),
        "day_of_year": F.dayofyear(d).cast("bigint"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
        "weekday": weekday_from_sunday(d),
    }


def span_days(first, last) -> Column:
    """Days from ``first`` to ``last``, both counted."""
    return F.datediff(_col(last), _col(first)).cast("bigint") + F.lit(1)


def utc(moment: dt.datetime) -> Column:
    """A naive UTC datetime as a literal that no session or system time zone shifts."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> Column:
    """The moment of the call, in UTC."""
    return utc(dt.datetime.now(dt.UTC).replace(tzinfo=None))


def iso_timestamp(text) -> Column:
    """ISO text (with or without a UTC suffix) to a zone-free UTC timestamp."""
    return _col(text).cast("timestamp_ntz")
