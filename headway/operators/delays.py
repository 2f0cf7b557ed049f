"""Schedule against actual travel time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import route_from_corridor
from headway.operators.quality import plausible_segments
from headway.operators.traffic import exact_percentile

# What counts as late, as on time, and as enough observations.
LATE_SECONDS = 60
ON_TIME_SECONDS = 120
MIN_SAMPLES = 3


def route_scheduled(segments: DataFrame, *, accuracy: int | None = None) -> DataFrame:
    """Scheduled seconds per segment of a route and departure hour."""
    return (
        plausible_segments(segments)
        .groupBy("route_id", "route_name", "route_type", "departure_hour")
        .agg(
            F.count(F.lit(1)).alias("scheduled_segments"),
            F.round(F.avg("scheduled_segment_seconds"), 0).alias("avg_scheduled_seconds"),
            F.round(
                exact_percentile("scheduled_segment_seconds", 0.5, accuracy=accuracy), 0
            ).alias("median_scheduled_seconds"),
        )
    )


def join_schedule_with_actual(
    scheduled: DataFrame, readings: DataFrame, *, wrap_hours: bool = False
) -> DataFrame:
    """Readings of a route's corridors next to the route's schedule of that hour.

    ``scheduled`` has one row per route and hour, so it is the small side; the
    readings are not shuffled when it fits the broadcast limit.  ``wrap_hours``
    also matches departures past midnight.
    """
    hour = F.col("departure_hour")
    plan = scheduled.withColumn("hour_of_day", F.pmod(hour, F.lit(24)) if wrap_hours else hour)
    actual = (
        readings.filter(
            F.col("corridor_id").startswith("route_") & F.col("duration_seconds").isNotNull()
        )
        .select(
            route_from_corridor(F.col("corridor_id")).alias("route_name"),
            "hour_of_day",
            F.col("corridor_name").alias("segment_name"),
            "day_type",
            F.col("poll_date").alias("report_date"),
            F.col("duration_seconds").alias("actual_seconds"),
            F.col("static_duration_seconds").alias("free_flow_seconds"),
            "congestion_ratio",
            "congestion_severity",
        )
    )
    late = F.col("actual_seconds") - F.col("avg_scheduled_seconds")
    share = late / F.nullif(F.col("avg_scheduled_seconds"), F.lit(0.0))
    return actual.join(plan, ["route_name", "hour_of_day"]).select(
        "route_id", "route_name", "route_type", "segment_name", "hour_of_day", "day_type",
        "report_date",
        F.col("avg_scheduled_seconds").alias("scheduled_seconds"),
        "scheduled_segments", "actual_seconds", "free_flow_seconds", "congestion_ratio",
        "congestion_severity",
        late.alias("delay_seconds"),
        F.round(share * 100, 1).alias("delay_pct"),
    )


def route_delay_patterns(
    comparison: DataFrame, *, min_samples: int = MIN_SAMPLES, accuracy: int | None = None
) -> DataFrame:
    """How late a route runs per hour and day type."""
    delay = F.col("delay_seconds")

    def percent(condition):
        return F.round(F.count_if(condition) * F.lit(100.0) / F.count(F.lit(1)), 1)

    return (
        comparison.filter(delay.isNotNull())
        .groupBy("route_id", "route_name", "route_type", "hour_of_day", "day_type")
        .agg(
            F.count(F.lit(1)).alias("sample_size"),
            F.round(F.avg(delay), 0).alias("avg_delay_seconds"),
            F.round(exact_percentile("delay_seconds", 0.5, accuracy=accuracy), 0).alias(
                "median_delay_seconds"
            ),
            F.round(exact_percentile("delay_seconds", 0.95, accuracy=accuracy), 0).alias(
                "p95_delay_seconds"
            ),
            F.round(F.max(delay), 0).alias("max_delay_seconds"),
            percent(delay > LATE_SECONDS).alias("pct_delayed"),
            percent(F.abs(delay) <= ON_TIME_SECONDS).alias("pct_on_time"),
            F.round(F.avg("congestion_ratio"), 3).alias("avg_congestion_ratio"),
            F.mode("congestion_severity", True).alias("typical_severity"),
        )
        .filter(F.col("sample_size") >= min_samples)
    )


def worst_delays(patterns: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest route, hour and day type groups."""
    return patterns.orderBy(
        F.desc("avg_delay_seconds"), "route_id", "hour_of_day", "day_type"
    ).limit(n)
