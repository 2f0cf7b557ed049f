"""Composite tables of the static schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import route_type_label
from headway.functions.times import departure_hour
from headway.operators.latest import latest_snapshot, newest_if_dated
from headway.operators.ordered import consecutive_pairs, sample_every_nth
from headway.operators.quality import non_terminal
from headway.operators.scd import END
from headway.operators.schedule import (
    SNAPSHOT,
    segment_distance,
    segment_seconds,
    stop_segments,
    with_route_labels,
    with_stop_ends,
    with_stop_ends_at,
)
from headway.operators.shapes import shape_route_bridge, shape_summary


def scheduled_times(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    stops: DataFrame,
    *,
    snapshot: str | None = None,
    all_snapshots: bool = False,
) -> DataFrame:
    """Scheduled seconds and kilometres from every stop to the next.

    Uses the newest snapshot, or the given one where the caller knows it and
    wants to save the look-up, or all of them.  ``stops`` holds current versions
    only, or is an ``scd2`` history: then a segment shows its stops as they were
    on its snapshot date.
    """
    if all_snapshots:
        pass
    elif snapshot is None:
        stop_times = latest_snapshot(stop_times, SNAPSHOT)
    else:
        stop_times = stop_times.filter(F.col(SNAPSHOT) == snapshot)
    legs = non_terminal(stop_segments(stop_times))
    labelled = with_route_labels(
        legs,
        trips.select(
            SNAPSHOT, "trip_id", "route_id", "trip_headsign", "direction_id", "service_id"
        ),
        routes.select(
            "route_id",
            F.col("route_short_name").alias("route_name"),
            "route_long_name",
            route_type_label(F.col("route_type")).alias("route_type"),
        ),
    )
    placed = with_stop_ends_at if END in stops.columns else with_stop_ends
    return placed(labelled, stops).select(
        "route_id", "route_name", "route_long_name", "route_type", "trip_headsign",
        "direction_id", "service_id",
        "origin_stop_id", "origin_stop_name", "origin_lat", "origin_lon",
        "dest_stop_id", "dest_stop_name", "dest_lat", "dest_lon",
        "stop_sequence", "departure_time", F.col("dest_arrival_time").alias("arrival_time"),
        segment_seconds().alias("scheduled_segment_seconds"),
        segment_distance().alias("segment_distance_km"),
        departure_hour(F.col("departure_time")).alias("departure_hour"),
        SNAPSHOT,
    )


def route_shapes(
    shapes: DataFrame, trips: DataFrame, routes: DataFrame, *, latest_only: bool = False
) -> DataFrame:
    """One row per route and shape with size, length, box and start.

    Shapes come from their newest snapshot; the pairs of shape and route from
    all snapshots unless ``latest_only``.
    """
    if SNAPSHOT in shapes.columns:
        shapes = latest_snapshot(shapes, SNAPSHOT)
    if latest_only:
        trips = latest_snapshot(trips, SNAPSHOT)
    bridge = shape_route_bridge(
        trips, routes.select("route_id", "route_short_name", "route_long_name")
    )
    return shape_summary(shapes).join(bridge, "shape_id").select(
        "shape_id", "route_id", F.col("route_short_name").alias("route_name"),
        "route_long_name", "num_points",
        F.round("total_distance_km", 2).alias("total_distance_km"),
        "start_lat", "start_lon", "min_lat", "max_lat", "min_lon", "max_lon",
    )


def route_segments(
    shapes: DataFrame, trips: DataFrame, routes: DataFrame, *, every: int = 10
) -> DataFrame:
    """Origin and destination pairs along every shape of the newest snapshot, with the route's columns.

    Every ``every``-th point starts a pair that ends at the next sampled point.
    """
    shapes, trips = newest_if_dated(shapes), newest_if_dated(trips)
    sampled = sample_every_nth(shapes, ["shape_id"], "shape_pt_sequence", every)
    numbered = sampled.select(
        "shape_id",
        (F.col("position") / every).cast("long").alias("segment"),
        "shape_pt_sequence",
        F.col("shape_pt_lat").alias("origin_lat"),
        F.col("shape_pt_lon").alias("origin_lon"),
    )
    pairs = consecutive_pairs(
        numbered, ["shape_id"], "segment", "origin_lat", "origin_lon"
    ).select(
        "shape_id", "origin_lat", "origin_lon",
        F.col("next_lat").alias("dest_lat"), F.col("next_lon").alias("dest_lon"),
        "shape_pt_sequence",
    )
    bridge = shape_route_bridge(
        trips, routes.select("route_id", "route_short_name", "route_long_name", "route_type")
    )
    return pairs.join(bridge, "shape_id")
