"""Route geometry: shape summaries, polylines, sampled segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import DEFAULT_ROUTE_COLOR, default_if_blank
from headway.operators.latest import newest_if_dated


def shape_summary(shapes: DataFrame) -> DataFrame:
    """Points, bounding box, length and first point of every shape."""
    point = F.struct("shape_pt_lat", "shape_pt_lon", "shape_pt_sequence")
    return shapes.groupBy("shape_id").agg(
        F.count_distinct(point).alias("num_points"),
        F.max("shape_dist_traveled").alias("total_distance_km"),
        F.min_by("shape_pt_lat", "shape_pt_sequence").alias("start_lat"),
        F.min_by("shape_pt_lon", "shape_pt_sequence").alias("start_lon"),
        F.min("shape_pt_lat").alias("min_lat"),
        F.max("shape_pt_lat").alias("max_lat"),
        F.min("shape_pt_lon").alias("min_lon"),
        F.max("shape_pt_lon").alias("max_lon"),
    )


def shape_route_bridge(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Distinct (shape, route) pairs with the route's columns."""
    pairs = trips.select("shape_id", "route_id").distinct()
    return pairs.join(routes, "route_id")


def shape_sizes(shapes: DataFrame) -> DataFrame:
    return shapes.groupBy("shape_id").agg(F.count(F.lit(1)).alias("points"))


def longest_shape(shapes: DataFrame, shape_routes: DataFrame, key: str = "route_id") -> DataFrame:
    """The shape with the most points per route, ties to the larger id."""
    sized = shape_routes.select(key, "shape_id").distinct().join(shape_sizes(shapes), "shape_id")
    rank = F.struct("points", "shape_id")
    return sized.groupBy(key).agg(
        F.max_by("shape_id", rank).alias("shape_id"), F.max("points").alias("points")
    )


def _coordinate_lists(shapes: DataFrame, *keys: Column | str) -> DataFrame:
    entry = F.struct(
        F.col("shape_pt_sequence").alias("seq"),
        F.col("shape_pt_lon").alias("lon"),
        F.col("shape_pt_lat").alias("lat"),
    )
    return (
        shapes.groupBy("shape_id", *keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("points"))
        .withColumn("coordinates", F.transform("points", lambda p: F.array(p["lon"], p["lat"])))
        .drop("points")
    )


def polylines(shapes: DataFrame) -> DataFrame:
    """One ordered coordinate list per shape, ``[lon, lat]`` per point.

    A shape is bounded by the road it follows, so one row can hold it.
    """
    return _coordinate_lists(shapes)


def polyline_parts(shapes: DataFrame, *, points: int) -> DataFrame:
    """Coordinate lists in parts of ``points`` sequence numbers, for readers that want short rows."""
    part = F.greatest(F.floor(F.col("shape_pt_sequence") / points), F.lit(0)).cast("int")
    return _coordinate_lists(shapes, part.alias("part"))


def route_polylines(shapes: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Coordinate lists of the newest snapshot with the route that runs along them."""
    shapes, trips = newest_if_dated(shapes), newest_if_dated(trips)
    labels = shape_route_bridge(trips, routes).select(
        "shape_id", "route_short_name", "route_long_name", "route_type", "route_color"
    ).distinct()
    return polylines(shapes).join(labels, "shape_id").select(
        "shape_id", "route_short_name", "route_long_name", "route_type",
        default_if_blank(F.col("route_color"), DEFAULT_ROUTE_COLOR).alias("route_color"),
        "coordinates",
    )


def route_geometries(serving_routes: DataFrame) -> DataFrame:
    """Serving routes with parsed coordinates and the default colour."""
    return serving_routes.select(
        "shape_id",
        F.col("route_short_name").alias("route_name"),
        "route_long_name",
        "route_type",
        default_if_blank(F.col("route_color"), DEFAULT_ROUTE_COLOR).alias("route_color"),
        F.from_json("coordinates", "array<array<double>>").alias("coordinates"),
    )
