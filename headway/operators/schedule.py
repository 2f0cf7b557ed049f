"""Schedule arithmetic over stop times: segments, frequencies, serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.times import departure_hour, gtfs_seconds
from headway.operators.latest import newest_if_dated
from headway.operators.ordered import with_next
from headway.operators.scd import END, START, versions_at

SNAPSHOT = "gtfs_snapshot_date"

# Hours shown in route profiles.
PROFILE_HOURS = (5, 24)


def stop_segments(stop_times: DataFrame) -> DataFrame:
    """Every stop of a trip with the stop after it."""
    legs = stop_times.select(
        SNAPSHOT,
        "trip_id",
        F.col("stop_id").alias("origin_stop_id"),
        "departure_time",
        "arrival_time",
        "stop_sequence",
        F.col("shape_dist_traveled").alias("origin_dist"),
    )
    return with_next(
        legs,
        [SNAPSHOT, "trip_id"],
        "stop_sequence",
        {
            "dest_stop_id": "origin_stop_id",
            "dest_arrival_time": "arrival_time",
            "dest_stop_sequence": "stop_sequence",
            "dest_dist": "origin_dist",
        },
    ).drop("arrival_time")


def segment_seconds() -> Column:
    return gtfs_seconds(F.col("dest_arrival_time")) - gtfs_seconds(F.col("departure_time"))


def segment_distance(origin: str = "origin_dist", dest: str = "dest_dist") -> Column:
    """Kilometres between two stops; a missing distance counts as zero."""
    zero = F.lit(0.0)
    return F.round(F.coalesce(F.col(dest), zero) - F.coalesce(F.col(origin), zero), 3)


def with_route_labels(segments: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Segments or stop times joined with their trip and the trip's route."""
    on_trip = [c for c in (SNAPSHOT, "trip_id") if c in segments.columns and c in trips.columns]
    return segments.join(trips, on_trip).join(routes, "route_id")


def with_stop_ends(segments: DataFrame, stops: DataFrame) -> DataFrame:
    """Names and coordinates of both stops of a segment; ``stops`` has one row per id."""
    for end in ("origin", "dest"):
        side = stops.select(
            F.col("stop_id").alias(f"{end}_stop_id"),
            F.col("stop_name").alias(f"{end}_stop_name"),
            F.col("stop_lat").alias(f"{end}_lat"),
            F.col("stop_lon").alias(f"{end}_lon"),
        )
        segments = segments.join(side, f"{end}_stop_id", "left")
    return segments


def with_stop_ends_at(segments: DataFrame, history: DataFrame) -> DataFrame:
    """Both stops of a segment as they were on its snapshot date, from an ``scd2`` history."""
    for end in ("origin", "dest"):
        side = history.select(
            F.col("stop_id").alias(f"{end}_stop_id"),
            F.col("stop_name").alias(f"{end}_stop_name"),
            F.col("stop_lat").alias(f"{end}_lat"),
            F.col("stop_lon").alias(f"{end}_lon"),
            START,
            END,
        )
        segments = versions_at(segments, side, [f"{end}_stop_id"], SNAPSHOT)
    return segments


def schedule_window(
    stop_times: DataFrame, first_hour: int, last_hour: int | None = None
) -> DataFrame:
    """Departures from ``first_hour`` to ``last_hour`` (two hours on by default)."""
    last = first_hour + 2 if last_hour is None else last_hour
    return stop_times.filter(departure_hour(F.col("departure_time")).between(first_hour, last))


def serving_stop_times(stop_times: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Stop times of the newest snapshot with the route and shape of their trip, ready for lookups."""
    return with_route_labels(
        newest_if_dated(stop_times).select(
            "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"
        ),
        newest_if_dated(trips).select("trip_id", "route_id", "shape_id"),
        routes.select("route_id", "route_short_name"),
    ).select(
        "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence",
        "route_id", "route_short_name", "shape_id",
    )


def stop_frequency(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Trips per stop and hour, with the stop's daily trips and busiest hour.

    One pass: calls are first reduced to (stop, trip) with the hours of that
    trip at the stop, which splits a hot stop over its trips.  A trip counts
    in each of its hours, and for the day only in the first.
    """
    visits = (
        stop_times.select(
            "stop_id", "trip_id", departure_hour(F.col("departure_time")).alias("hour")
        )
        .filter(F.col("hour").isNotNull())
        .groupBy("stop_id", "trip_id")
        .agg(F.collect_set("hour").alias("hours"))
    )
    hourly = (
        visits.select("stop_id", F.posexplode("hours").alias("nth", "hour_of_day"))
        .groupBy("stop_id", "hour_of_day")
        .agg(
            F.count(F.lit(1)).alias("trip_count"), F.count_if(F.col("nth") == 0).alias("__first")
        )
    )
    # One row per hour is left, so a stop's window holds a few dozen rows.
    stop = Window.partitionBy("stop_id")
    busiest = F.struct(F.col("trip_count"), -F.col("hour_of_day"))
    totals = hourly.withColumns(
        {
            "trips_per_day": F.sum("__first").over(stop),
            "peak_hour": F.max_by("hour_of_day", busiest).over(stop),
            "peak_trips": F.max("trip_count").over(stop),
        }
    )
    places = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
    return totals.join(places, "stop_id").select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "hour_of_day", "trip_count",
        "trips_per_day", "peak_hour", "peak_trips",
    )


def route_frequency(stop_times: DataFrame, hour: int) -> DataFrame:
    """Distinct trips and stops per route in one hour, and one of its shapes.

    Trips and stops are made distinct in two small groupings of their own, so
    no row is copied for the two counts.
    """
    route = [F.col("route_short_name").alias("route_name"), F.col("route_id")]
    calls = stop_times.filter(
        (departure_hour(F.col("departure_time")) == hour) & F.col("route_short_name").isNotNull()
    )
    trips = calls.groupBy(*route, "trip_id").agg(F.min("shape_id").alias("shape_id"))
    stops = calls.groupBy(*route, "stop_id").agg(F.count(F.lit(1)).alias("calls"))
    named = ["route_name", "route_id"]
    return (
        trips.groupBy(*named)
        .agg(F.count("trip_id").alias("trips"), F.min("shape_id").alias("sample_shape_id"))
        .join(stops.groupBy(*named).agg(F.count("stop_id").alias("stops_served")), named)
        .select(*named, "trips", "stops_served", "sample_shape_id")
    )


def route_hourly_trips(stop_times: DataFrame) -> DataFrame:
    """Distinct trips per route and hour, for the hours shown in profiles."""
    return (
        schedule_window(stop_times, *PROFILE_HOURS)
        .groupBy("route_id", departure_hour(F.col("departure_time")).alias("hour"))
        .agg(F.count_distinct("trip_id").alias("trips"))
    )


def route_hourly_profile(stop_times: DataFrame) -> DataFrame:
    """The hourly trips of a route as one sorted list (at most 20 entries)."""
    entries = F.sort_array(F.collect_list(F.struct("hour", "trips")))
    return route_hourly_trips(stop_times).groupBy("route_id").agg(
        entries.alias("hourly_profile")
    )
