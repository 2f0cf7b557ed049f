"""Corridor lists to poll, built from shapes or from exported waypoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.corridors import (
    MIN_SHAPE_POINTS,
    MIN_SHAPE_SEGMENT_KM,
    MIN_WAYPOINT_SEGMENT_KM,
    PRIORITY_BY_SHAPES,
    PRIORITY_BY_WAYPOINTS,
    SEGMENTS_PER_ROUTE,
    corridor_rows,
    evenly_spaced_segments,
    segment_km,
    select_routes,
)
from headway.operators.latest import distinct_on, newest_if_dated
from headway.operators.ordered import picked_places, with_position
from headway.operators.shapes import shape_sizes


def _one_per_name(routes: DataFrame) -> DataFrame:
    """Of routes with the same short name the last by id; unnamed ones have no corridors."""
    named = routes.filter(F.col("route_short_name").isNotNull()).select(
        "route_id", "route_short_name", "route_long_name", "route_type"
    )
    return distinct_on(named, ["route_short_name"], [F.desc("route_id")])


def corridors_from_shapes(
    shapes: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    *,
    max_routes: int | None = None,
    per_route: int = SEGMENTS_PER_ROUTE,
) -> DataFrame:
    """Evenly spaced segments along the longest shape of each selected route.

    All tables are taken from their newest snapshot.  Of routes with one short
    name the last by id counts, because corridor ids are built from the name.
    Only the points of chosen shapes are numbered, once per route that chose
    them.  Numbers of segments that are too short stay unused.
    """
    shapes, trips = newest_if_dated(shapes), newest_if_dated(trips)
    pairs = trips.filter(F.col("shape_id").isNotNull()).select("route_id", "shape_id").distinct()
    rank = F.struct("points", "shape_id")
    longest = (
        pairs.join(shape_sizes(shapes), "shape_id", "left")
        .groupBy("route_id")
        .agg(
            F.count(F.lit(1)).alias("shapes"), F.max("points").alias("points"),
            F.max_by("shape_id", F.when(F.col("points").isNotNull(), rank)).alias("shape_id"),
        )
    )
    chosen = select_routes(
        _one_per_name(routes).join(longest, "route_id"),
        priority=PRIORITY_BY_SHAPES, max_routes=max_routes,
    ).filter(F.col("points") >= MIN_SHAPE_POINTS)
    # The route goes along with its points, so that it need not be looked up again.
    route = F.struct("route_id", "route_short_name", "route_long_name", "route_type").alias("route")
    used = shapes.select("shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon").join(
        chosen.select("shape_id", route), "shape_id"
    )
    placed = with_position(used, ["route"], "shape_pt_sequence", size="group_size")
    cut = evenly_spaced_segments(placed, "route", per_route).withColumn("km", segment_km())
    long_enough = cut.filter(F.col("km") >= MIN_SHAPE_SEGMENT_KM)
    return corridor_rows(long_enough.select("*", "route.*"), F.col("segment") + 1)


def corridors_from_waypoints(
    waypoints: DataFrame,
    routes: DataFrame,
    *,
    order: str = "waypoint_no",
    major: tuple[str, ...] = ("shape_id",),
    max_routes: int | None = None,
    per_route: int = SEGMENTS_PER_ROUTE,
) -> DataFrame:
    """Waypoints of useful length, evenly picked per selected route.

    A route with no useful waypoint falls back to its first ones.  Numbers run
    from 1 without gaps.
    """
    measured = waypoints.withColumn("km", segment_km())
    useful = F.col("km") >= MIN_WAYPOINT_SEGMENT_KM
    counted = measured.groupBy("route_name").agg(
        F.count(F.lit(1)).alias("waypoints"), F.count_if(useful).alias("useful")
    )
    named = _one_per_name(routes)
    chosen = select_routes(
        named.join(counted, named["route_short_name"] == counted["route_name"]),
        priority=PRIORITY_BY_WAYPOINTS, count="waypoints", max_routes=max_routes,
    )
    # A route is represented by its useful waypoints, or, without any, by its first ones.
    along = measured.join(chosen.drop("waypoints"), "route_name").filter(
        useful | (F.col("useful") == 0)
    )
    placed = with_position(along, ["route_name"], order, major=major, size="group_size")
    spread = F.when(F.col("useful") > 0, F.col("group_size")).otherwise(F.lit(per_route))
    return corridor_rows(
        picked_places(placed, spread, per_route), F.col("pick") + 1, on_demand=True
    )
