"""Vehicle positions: speeds, congestion grid, route speeds, painted routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.geo import GRID_SIZE, grid_cell, haversine_km
from headway.functions.labels import congestion_level
from headway.operators.latest import distinct_on, top_per_key
from headway.operators.ordered import consecutive_pairs, with_position
from headway.operators.shapes import longest_shape

# Usable time gap, least movement, fastest plausible vehicle,
# pieces per painted route.
MIN_GAP_S, MAX_GAP_S = 5, 120
MIN_MOVE_KM = 0.005
MAX_KMH = 80
PAINTED_PIECES = 30

# Length of one slice of a vehicle's day; longer than the largest usable gap.
SLICE_S = 1800


def drop_unlocated(vehicles: DataFrame) -> DataFrame:
    """Located vehicles with rounded coordinates and km/h in place of m/s."""
    speed = F.col("speed")
    return vehicles.filter(F.col("lat").isNotNull() & (F.col("lat") != 0)).withColumns(
        {
            "lat": F.round("lat", 6),
            "lon": F.round("lon", 6),
            "bearing": F.round("bearing", 1),
            "speed": F.when(speed != 0, F.round(speed * 3.6, 1)),
        }
    )


def label_vehicles(positions: DataFrame, routes: DataFrame) -> DataFrame:
    """Positions with the short name of their route, or its id without one."""
    names = distinct_on(
        routes.select("route_id", "route_short_name"), ["route_id"], ["route_short_name"]
    )
    return positions.join(names, "route_id", "left").withColumn(
        "route", F.coalesce("route_short_name", "route_id")
    ).drop("route_short_name")


def vehicle_speeds(
    positions: DataFrame, *, tie_break: Sequence[str] = (), slice_s: int = SLICE_S
) -> DataFrame:
    """Speed of every position, reported or computed from the one before.

    A reported speed above zero counts as it is; otherwise distance over time
    since the vehicle's previous position, if that is 5 to 120 s ago and the
    vehicle has moved 5 m.  Rows without a speed, or at 80 km/h and above, drop
    out but still serve as the previous position of the next one.

    A vehicle's day is cut into slices, so a vehicle with very many positions
    spreads over tasks.  Only a position of the last 120 s can matter, so the
    end of each slice is copied in front of the next.
    """
    window = Window.partitionBy("id", "__slice").orderBy("ts", *tie_break)
    placed = cut_slices(positions, slice_s).withColumns(
        {
            "__ts": F.lag(F.col("ts").cast("double")).over(window),
            "__lat": F.lag("lat").over(window),
            "__lon": F.lag("lon").over(window),
        }
    )
    own = placed.filter(F.col("__slice") == F.col("__own")).drop("__slice", "__own")
    return speeds_from_previous(own)


def cut_slices(positions: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """Positions in their own slice, and once more in the next one if they can matter there."""
    at = F.col("ts").cast("double")
    own = F.floor(at / slice_s).cast("long")
    follows = F.floor((at + MAX_GAP_S) / slice_s).cast("long")
    slices = F.when(follows > own, F.array(own, follows)).otherwise(F.array(own))
    return positions.withColumn("__slice", F.explode(slices)).withColumn("__own", own)


def speeds_from_previous(rows: DataFrame) -> DataFrame:
    """Speeds of positions that carry time and place of the one before: __ts, __lat, __lon."""
    gap = F.col("ts").cast("double") - F.col("__ts")
    moved = haversine_km(F.col("__lat"), F.col("__lon"), F.col("lat"), F.col("lon"))
    usable = (gap > MIN_GAP_S) & (gap < MAX_GAP_S) & (moved > MIN_MOVE_KM)
    speed = F.when(F.col("speed") > 0, F.col("speed")).when(
        usable, F.round(moved / (gap / 3600), 1)
    )
    return (
        rows.withColumn("speed_kmh", speed)
        .filter(F.col("speed_kmh") < MAX_KMH)
        .drop("__ts", "__lat", "__lon")
    )


def _tenths() -> Column:
    """Speeds carry one digit; summed as decimals the order of tasks cannot show."""
    return F.col("speed_kmh").cast("decimal(10,1)")


def grid_congestion(speeds: DataFrame, grid: float = GRID_SIZE) -> DataFrame:
    """Average speed, level, sample count and routes per grid cell.

    Speeds are summed per (cell, route) first, so the second step sees at most
    one row per route that crosses a cell.
    """
    by_route = (
        speeds.groupBy(
            grid_cell(F.col("lat"), grid).alias("lat"),
            grid_cell(F.col("lon"), grid).alias("lon"),
            "route",
        )
        .agg(F.sum(_tenths()).alias("total"), F.count(F.lit(1)).alias("samples"))
    )
    average = F.sum("total").cast("double") / F.sum("samples")
    return by_route.groupBy("lat", "lon").agg(
        F.round(average, 1).alias("avg_speed"),
        congestion_level(average).alias("level"),
        F.sum("samples").alias("count"),
        F.sort_array(F.collect_list("route")).alias("routes"),
    )


def route_speeds(speeds: DataFrame) -> DataFrame:
    """Average speed and sample count of every named route."""
    return (
        speeds.filter(F.coalesce(F.col("route"), F.lit("")) != "")
        .groupBy("route")
        .agg(
            (F.sum(_tenths()).cast("double") / F.count(F.lit(1))).alias("avg_speed"),
            F.count(F.lit(1)).alias("samples"),
        )
    )


def slow_cells(grid: DataFrame) -> DataFrame:
    return grid.filter(F.col("level").isin("HIGH", "MEDIUM"))


def grid_totals(grid: DataFrame) -> DataFrame:
    """Number of cells and of slow cells."""
    return grid.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("level").isin("HIGH", "MEDIUM")).alias("slow"),
    )


def paint_routes(speeds_by_route: DataFrame, shapes: DataFrame, shape_routes: DataFrame):
    """Average route speed laid on about 30 pieces of the route's longest shape.

    ``shape_routes`` maps shapes to the ``route`` label of the speeds.  Every
    step-th point of the shape starts a piece that ends at the next one; what
    is left behind the last full step is not painted.
    """
    longest = longest_shape(shapes, shape_routes, "route").select("route", "shape_id")
    # Several routes may share a shape, so points are placed per shape first, of painted shapes only.
    used = shapes.join(longest.select("shape_id").distinct(), "shape_id", "left_semi")
    placed = with_position(used, ["shape_id"], "shape_pt_sequence", size="group_size")
    step = F.greatest(F.lit(1), F.floor(F.col("group_size") / PAINTED_PIECES)).cast("long")
    corners = placed.filter(F.col("position") % step == 0).withColumn(
        "piece", (F.col("position") / step).cast("long")
    )
    pieces = consecutive_pairs(
        corners.select("shape_id", "piece", "shape_pt_lat", "shape_pt_lon"),
        ["shape_id"], "piece", "shape_pt_lat", "shape_pt_lon",
    )
    average = F.col("avg_speed")
    return (
        pieces.join(longest, "shape_id")
        .join(speeds_by_route, "route")
        .select(
            "route", "shape_id", "piece",
            F.col("shape_pt_lon").alias("start_lon"), F.col("shape_pt_lat").alias("start_lat"),
            F.col("next_lon").alias("end_lon"), F.col("next_lat").alias("end_lat"),
            congestion_level(average).alias("level"),
            F.format_string("%s km/h", F.round(average, 1).cast("string")).alias("speed"),
            F.lit("bus_route").alias("source"),
            "samples",
        )
    )


def newest_positions(
    positions: DataFrame, within_s: int, *, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Newest position per vehicle, for vehicles heard within ``within_s`` of the last one."""
    last = positions.agg(F.max("ts").alias("last")).scalar()
    heard = positions.filter(F.col("ts") >= last - within_s)
    return top_per_key(heard, ["id"], [F.desc("ts"), *[F.desc_nulls_last(c) for c in tie_break]])
