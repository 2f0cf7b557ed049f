"""Traffic readings: classification, hourly patterns, daily summaries, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import (
    SEVERITIES,
    congestion_severity,
    route_from_corridor,
    route_type_label,
)
from headway.functions.responses import congestion_ratio, parse_duration, parsed_response
from headway.functions.times import (
    day_of_week,
    day_type,
    hour_of_day,
    local_time,
    time_period,
)

PATTERN_KEYS = (
    "corridor_id", "corridor_name", "day_of_week", "day_type", "hour_of_day", "time_period",
)


def exact_percentile(column: str, p: float, *, accuracy: int | None = None) -> Column:
    """Interpolated percentile, or the sketch of the given accuracy.

    The exact form keeps one counter per distinct value of a group.  Durations
    are whole seconds and ratios carry 4 digits, so that stays a few thousand
    counters however many rows a group has, and is merged map-side.
    """
    if accuracy is None:
        return F.percentile(column, F.lit(p))
    return F.percentile_approx(column, p, accuracy)


def parse_route_response(responses: DataFrame) -> DataFrame:
    """Travel figures of the first route in each stored response."""
    route = F.get(parsed_response(F.col("api_response_json"))["routes"], 0)
    return (
        responses.withColumn("__route", route)
        .withColumns(
            {
                "duration_seconds": parse_duration(F.col("__route")["duration"]),
                "static_duration_seconds": parse_duration(F.col("__route")["staticDuration"]),
                "distance_meters": F.col("__route")["distanceMeters"],
            }
        )
        .withColumn(
            "congestion_ratio",
            congestion_ratio(F.col("duration_seconds"), F.col("static_duration_seconds")),
        )
        .drop("__route")
    )


def with_time_dimensions(readings: DataFrame, ts: str = "polled_at", tz: str | None = None):
    """Hour, weekday, date, period of day and day type of a reading."""
    at = F.col(ts)
    hour, weekday = hour_of_day(at, tz), day_of_week(at, tz)
    return readings.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": weekday,
            "poll_date": F.to_date(local_time(at, tz)),
            "time_period": time_period(hour),
            "day_type": day_type(weekday),
        }
    )


def with_severity(readings: DataFrame, *, null_label: str | None = "severe") -> DataFrame:
    label = congestion_severity(F.col("congestion_ratio"), null_label=null_label)
    return readings.withColumn("congestion_severity", label)


def congestion_patterns(readings: DataFrame, *, accuracy: int | None = None) -> DataFrame:
    """Typical congestion per corridor, weekday and hour."""
    severity = F.col("congestion_severity")
    return readings.groupBy(*PATTERN_KEYS).agg(
        F.count(F.lit(1)).alias("num_observations"),
        F.round(F.avg("congestion_ratio"), 3).alias("avg_congestion_ratio"),
        F.round(exact_percentile("congestion_ratio", 0.5, accuracy=accuracy), 3).alias(
            "median_congestion_ratio"
        ),
        F.round(exact_percentile("congestion_ratio", 0.95, accuracy=accuracy), 3).alias(
            "p95_congestion_ratio"
        ),
        F.round(F.avg("duration_seconds"), 0).alias("avg_duration_seconds"),
        F.round(F.avg("distance_meters"), 0).alias("avg_distance_meters"),
        *[F.count_if(severity == name).alias(f"{name}_count") for name in SEVERITIES],
    )


def corridor_daily(readings: DataFrame) -> DataFrame:
    """Figures per corridor and day."""
    return readings.groupBy("corridor_id", "corridor_name", "poll_date", "day_type").agg(
        F.count(F.lit(1)).alias("num_readings"),
        F.round(F.avg("congestion_ratio"), 3).alias("avg_congestion_ratio"),
        F.round(F.max("congestion_ratio"), 3).alias("peak_congestion_ratio"),
        *[
            F.round(F.avg(c), 0).alias(f"avg_{c}")
            for c in ("duration_seconds", "static_duration_seconds", "distance_meters")
        ],
    )


def corridor_to_route(corridors: DataFrame, routes: DataFrame) -> DataFrame:
    """Corridor rows with the route named in their id.

    Unmatched corridors stay, typed ``other``; several routes of one short
    name give several rows.
    """
    named = routes.select(
        "route_id", F.col("route_short_name").alias("route_name"), "route_long_name", "route_type"
    )
    return (
        corridors.withColumn("route_name_key", route_from_corridor(F.col("corridor_id")))
        .join(named, F.col("route_name_key") == named["route_name"], "left")
        .drop("route_name_key")
        .withColumn("route_type", route_type_label(F.col("route_type")))
    )


def current_delay(readings: DataFrame) -> DataFrame:
    """Seconds lost against free flow, the most congested first.

    Corridor and time break ties, so that a ratio shared by very many readings
    still sorts into several ranges.
    """
    delay = F.col("duration_seconds") - F.col("static_duration_seconds")
    return most_congested_now(readings.withColumn("delay_seconds", delay))


def most_congested_now(readings: DataFrame, n: int | None = None) -> DataFrame:
    """Readings by congestion, optionally only the first ``n``."""
    ranked = readings.orderBy(
        F.desc_nulls_last("congestion_ratio"), "corridor_id", "polled_at"
    )
    return ranked if n is None else ranked.limit(n)


# Business names of the two published views.
TRAFFIC_VIEW = {
    "corridor_id": "corridor_id",
    "corridor_name": "Corridor Name",
    "hour_of_day": "Hour of Day",
    "day_type": "Day Type",
    "time_period": "Time Period",
    "congestion_severity": "Congestion Severity",
    "poll_date": "Report Date",
    "congestion_ratio": "Congestion Ratio",
    "duration_seconds": "Travel Time (seconds)",
    "static_duration_seconds": "Free Flow Time (seconds)",
    "distance_meters": "Distance (meters)",
}
ROUTE_VIEW = {
    "route_id": "route_id",
    "route_name": "Route Name",
    "route_type": "Route Type",
    "hour_of_day": "Hour of Day",
    "day_type": "Day Type",
    "avg_delay_seconds": "Avg Delay (seconds)",
    "median_delay_seconds": "Median Delay (seconds)",
    "p95_delay_seconds": "P95 Delay (seconds)",
    "pct_delayed": "% Delayed",
    "pct_on_time": "% On Time",
    "avg_congestion_ratio": "Avg Congestion Ratio",
    "typical_severity": "Typical Severity",
    "sample_size": "Sample Size",
}


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def traffic_congestion_metrics(readings: DataFrame) -> DataFrame:
    return _renamed(readings, TRAFFIC_VIEW)


def route_performance_metrics(delays: DataFrame) -> DataFrame:
    return _renamed(delays, ROUTE_VIEW)
