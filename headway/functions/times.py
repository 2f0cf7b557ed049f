"""Time expressions: GTFS clock texts, reading-time dimensions, cache keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(text: Column, index: int) -> Column:
    return F.get(F.split(text, ":"), index).try_cast("int")


def gtfs_seconds(clock: Column) -> Column:
    """Seconds since midnight of ``HH:MM:SS``; hours may pass 24, bad text is NULL."""
    return _part(clock, 0) * 3600 + _part(clock, 1) * 60 + _part(clock, 2)


def departure_hour(clock: Column, *, wrap: bool = False) -> Column:
    """Hour of a GTFS clock text.  ``wrap`` folds hours past midnight into 0-23."""
    hour = _part(clock, 0)
    return F.pmod(hour, F.lit(24)) if wrap else hour


def local_time(ts: Column, tz: str | None) -> Column:
    """A UTC timestamp on the wall clock of ``tz`` (unchanged without one)."""
    return ts if tz is None else F.from_utc_timestamp(ts, tz)


def hour_of_day(ts: Column, tz: str | None = None) -> Column:
    return F.hour(local_time(ts, tz))


def day_of_week(ts: Column, tz: str | None = None) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(local_time(ts, tz))


def time_period(hour: Column) -> Column:
    return (
        F.when(hour.between(7, 9), "morning_rush")
        .when(hour.between(10, 15), "midday")
        .when(hour.between(16, 18), "evening_rush")
        .when(hour.between(19, 21), "evening")
        .otherwise("overnight")
    )


def day_type(weekday: Column) -> Column:
    return F.when(weekday.isin(1, 7), "weekend").otherwise("weekday")


def quarter_key(ts: Column, tz: str | None = None, *, prefix: str = "") -> Column:
    """15-minute key ``{hour}_{day}_q{quarter}``."""
    at = local_time(ts, tz)
    quarter = (F.floor(F.minute(at) / 15) * 15).cast("int")
    return F.concat(
        F.lit(prefix), F.hour(at).cast("string"), F.lit("_"),
        F.dayofweek(at).cast("string"), F.lit("_q"), quarter.cast("string"),
    )


def hour_key(hour: Column, day: Column) -> Column:
    """Hourly key ``{hour}_{day}``."""
    return F.concat_ws("_", hour.cast("string"), day.cast("string"))


def route_key(hour: Column, day: Column, route: Column) -> Column:
    """Hourly key of one route, ``{hour}_{day}_r_{route}``."""
    return F.concat(hour_key(hour, day), F.lit("_r_"), F.lower(route))
