"""Composite tables of traffic readings and their comparison with the schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.operators.delays import (
    join_schedule_with_actual,
    route_delay_patterns,
    route_scheduled,
)
from headway.operators.latest import dedupe_latest
from headway.operators.quality import drop_failed_polls
from headway.operators.traffic import (
    corridor_daily,
    corridor_to_route,
    with_severity,
    with_time_dimensions,
)


def traffic_readings(
    raw: DataFrame,
    *,
    tz: str | None = None,
    newest: tuple[str, ...] = ("_file_arrival_time",),
    null_label: str | None = "severe",
) -> DataFrame:
    """Cleaned readings: failed polls dropped, one per corridor and poll, classified."""
    once = dedupe_latest(drop_failed_polls(raw), newest=newest)
    return classified_readings(once, tz=tz, null_label=null_label)


def classified_readings(
    once: DataFrame, *, tz: str | None = None, null_label: str | None = "severe"
) -> DataFrame:
    """Single polls with their severity and time dimensions, without the stored response."""
    classified = with_time_dimensions(with_severity(once, null_label=null_label), tz=tz)
    return classified.drop("api_response_json", "_file_arrival_time")


def corridor_daily_summary(readings: DataFrame, routes: DataFrame) -> DataFrame:
    """Daily corridor figures with the route named in the corridor id."""
    daily = corridor_daily(readings).withColumnRenamed("poll_date", "report_date")
    return corridor_to_route(daily, routes)


def schedule_vs_actual(
    segments: DataFrame,
    readings: DataFrame,
    *,
    wrap_hours: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Measured travel times against the scheduled seconds of the same route and hour.

    The schedule figure is the average of one stop-to-stop leg, the measured
    one covers a whole corridor segment.
    """
    plan = route_scheduled(segments, accuracy=accuracy)
    return join_schedule_with_actual(plan, readings, wrap_hours=wrap_hours)


def delay_patterns(
    segments: DataFrame, readings: DataFrame, *, accuracy: int | None = None
) -> DataFrame:
    """Which routes run late, when, and by how much."""
    compared = schedule_vs_actual(segments, readings, accuracy=accuracy)
    return route_delay_patterns(compared, accuracy=accuracy)
