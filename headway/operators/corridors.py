"""Route selection and corridor construction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.functions.geo import haversine_km
from headway.functions.labels import (
    DEFAULT_ZONE,
    LANES,
    corridor_id,
    corridor_name,
    corridor_type_label,
    speed_limit,
)

# Routes that are always selected, by short name.
PRIORITY_BY_SHAPES = (
    "099", "99", "R1", "R2", "R3", "R4", "R5",
    "009", "9", "014", "14", "025", "25", "041", "41", "049", "49",
    "003", "3", "008", "8", "019", "19", "020", "20",
)
PRIORITY_BY_WAYPOINTS = (
    "R1", "R2", "R3", "R4", "R5",
    "099", "99",
    "009", "9", "014", "14", "025", "25", "041", "41", "049", "49",
    "003", "3", "008", "8", "019", "19", "020", "20",
    "N19", "N9", "N10", "N15", "N17", "N22", "N24",
)
# How many segments, and the shortest useful ones.
SEGMENTS_PER_ROUTE = 3
MIN_SHAPE_POINTS = 4
MIN_SHAPE_SEGMENT_KM = 0.3
MIN_WAYPOINT_SEGMENT_KM = 0.5

# Bridges and highways that bus routes do not cover.
ARTERIALS = (
    ("Lions Gate Bridge", 49.3155, -123.1385, 49.3284, -123.1363),
    ("Ironworkers Memorial", 49.2935, -123.0235, 49.3055, -123.0205),
    ("Alex Fraser Bridge", 49.1645, -122.9440, 49.1805, -122.9365),
    ("Port Mann Bridge", 49.2095, -122.8165, 49.2185, -122.7945),
    ("Pattullo Bridge", 49.2075, -122.8885, 49.2145, -122.8895),
    ("Hwy 1 Burnaby", 49.2640, -123.0100, 49.2580, -122.9400),
    ("Hwy 1 Coquitlam", 49.2580, -122.9400, 49.2485, -122.8600),
    ("Oak Street Bridge", 49.2105, -123.1295, 49.2275, -123.1270),
    ("Arthur Laing Bridge", 49.2015, -123.1560, 49.2115, -123.1475),
    ("Massey Tunnel", 49.1360, -123.0715, 49.1475, -123.0665),
    ("Knight St Bridge", 49.2055, -123.0765, 49.2175, -123.0765),
    ("Kingsway Burnaby", 49.2320, -123.0465, 49.2435, -123.0160),
    ("Marine Drive", 49.2095, -123.1605, 49.2085, -123.1095),
    ("Lougheed Hwy", 49.2565, -122.8925, 49.2535, -122.8165),
    ("Canada Way", 49.2425, -123.0050, 49.2500, -122.9475),
)


def arterial_corridors(spark: SparkSession) -> DataFrame:
    """The fixed table of arterial corridors."""
    return spark.createDataFrame(
        list(ARTERIALS),
        "name STRING, origin_lat DOUBLE, origin_lon DOUBLE, dest_lat DOUBLE, dest_lon DOUBLE",
    )


def select_routes(
    counted: DataFrame,
    *,
    priority: tuple[str, ...] = PRIORITY_BY_SHAPES,
    count: str = "shapes",
    max_routes: int | None = None,
) -> DataFrame:
    """Priority routes, then those with the highest count until ``max_routes``.

    ``counted`` has one row per route.  Priority routes are all kept, even if
    they alone exceed the limit; without a limit all routes are.
    """
    if max_routes is None:
        return counted
    first = F.col("route_short_name").isin(*priority)
    priorities = counted.filter(first)
    room = F.greatest(F.lit(max_routes) - F.count(F.lit(1)), F.lit(0))
    left = priorities.agg(room.alias("room")).scalar()
    # Ordered top-k first, so that only max_routes rows are numbered in one task.
    fill = (
        counted.filter(~F.coalesce(first, F.lit(False)))
        .orderBy(F.desc(count), "route_id")
        .limit(max_routes)
        .withColumn(
            "__rank", F.row_number().over(Window.orderBy(F.desc(count), F.asc("route_id")))
        )
        .filter(F.col("__rank") <= left)
        .drop("__rank")
    )
    return priorities.unionByName(fill)


def corridor_rows(segments: DataFrame, number: Column, *, on_demand: bool = False) -> DataFrame:
    """Corridor records of numbered segments with their route's columns."""
    kind = corridor_type_label(F.col("route_type"), on_demand=on_demand)
    name, long_name = F.col("route_short_name"), F.col("route_long_name")
    return segments.select(
        corridor_id(name, number).alias("corridor_id"),
        corridor_name(name, long_name, number).alias("corridor_name"),
        kind.alias("corridor_type"),
        "route_id",
        "route_short_name",
        F.lit(DEFAULT_ZONE).alias("zone"),
        speed_limit(kind).alias("speed_limit_kmh"),
        F.lit(LANES).alias("num_lanes"),
        F.struct(F.col("origin_lat").alias("lat"), F.col("origin_lon").alias("lng")).alias(
            "origin"
        ),
        F.struct(F.col("dest_lat").alias("lat"), F.col("dest_lon").alias("lng")).alias(
            "destination"
        ),
        F.round(F.col("km"), 2).alias("distance_km"),
    )


def segment_km() -> Column:
    return haversine_km(
        F.col("origin_lat"), F.col("origin_lon"), F.col("dest_lat"), F.col("dest_lon")
    )


def evenly_spaced_segments(placed: DataFrame, key: str, k: int = SEGMENTS_PER_ROUTE) -> DataFrame:
    """``k`` segments of equal length from the start of every point sequence.

    ``placed`` carries ``position`` and ``group_size``.  Segment i runs from
    point i * step to (i + 1) * step, at most to the last point, with step =
    max(1, n // (k + 1)); it only exists where its ends differ.  Points are
    sent to the segments they bound, so no sequence is gathered anywhere.
    """
    n, at = F.col("group_size"), F.col("position")
    step = F.greatest(F.lit(1), F.floor(n / (k + 1))).cast("long")
    roles = []
    for i in range(k):
        last = F.least(step * (i + 1), n - 1)
        exists = F.lit(i) * step < last
        roles.append(F.when(exists & (at == F.lit(i) * step), F.struct(F.lit(i), F.lit(0))))
        roles.append(F.when(exists & (at == last), F.struct(F.lit(i), F.lit(1))))
    role = F.explode(F.filter(F.array(*roles), lambda r: r.isNotNull()))
    marked = placed.withColumn("__role", role).select(
        key, "group_size", "shape_pt_lat", "shape_pt_lon",
        F.col("__role.col1").alias("segment"), F.col("__role.col2").alias("__end"),
    )

    def end(which: int, column: str) -> Column:
        return F.max(F.when(F.col("__end") == which, F.col(column)))

    return marked.groupBy(key, "segment").agg(
        F.max("group_size").alias("points"),
        end(0, "shape_pt_lat").alias("origin_lat"),
        end(0, "shape_pt_lon").alias("origin_lon"),
        end(1, "shape_pt_lat").alias("dest_lat"),
        end(1, "shape_pt_lon").alias("dest_lon"),
    )


def corridors_by_type(corridors: DataFrame) -> DataFrame:
    return corridors.groupBy("corridor_type").agg(F.count(F.lit(1)).alias("segments"))
