"""Geographic range and nearest-neighbour joins as bucketed equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.geo import GRID_SIZE, bucket, equirect_m
from headway.operators.latest import top_per_key

# Search box and radius around a point.
BOX_LAT, BOX_LON, RADIUS_M = 0.008, 0.012, 800.0

# Width in degrees of the smallest cell of the nearest-stop search.
FINEST = 0.002 / 3**6


def covering(degrees: Column, reach: float, size: float) -> Column:
    """Numbers of all buckets that a window of ``reach`` around a value touches."""
    return F.sequence(bucket(degrees - reach, size), bucket(degrees + reach, size))


def within_box(
    points: DataFrame,
    targets: DataFrame,
    *,
    lat: str,
    lon: str,
    target_lat: str,
    target_lon: str,
    reach_lat: float,
    reach_lon: float,
) -> DataFrame:
    """Pairs whose coordinates differ by less than the two reaches.

    Points are copied to the 2 or 3 buckets per axis that their box touches;
    targets stay single.  The join is an equi-join on the bucket, so a hot
    bucket is split by the adaptive skew join instead of a nested loop.
    Points are dealt to all tasks first: a small file of them can have far more
    pairs than rows, and where targets are broadcast nothing else spreads them.
    The number of tasks is given, as the bytes of the points say nothing of it.
    """
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = points.repartition(tasks).withColumn(
        "__by", F.explode(covering(F.col(lat), reach_lat, reach_lat))
    ).withColumn("__bx", F.explode(covering(F.col(lon), reach_lon, reach_lon)))
    placed = targets.withColumns(
        {
            "__by": bucket(F.col(target_lat), reach_lat),
            "__bx": bucket(F.col(target_lon), reach_lon),
        }
    )
    near = (F.abs(F.col(target_lat) - F.col(lat)) < reach_lat) & (
        F.abs(F.col(target_lon) - F.col(lon)) < reach_lon
    )
    return spread.join(placed, ["__by", "__bx"]).filter(near).drop("__by", "__bx")


def stops_within(
    points: DataFrame,
    stops: DataFrame,
    *,
    lat: str = "lat",
    lon: str = "lon",
    radius_m: float = RADIUS_M,
) -> DataFrame:
    """Stops less than ``radius_m`` from each point, inside the search box."""
    pairs = within_box(
        points, stops, lat=lat, lon=lon, target_lat="stop_lat", target_lon="stop_lon",
        reach_lat=BOX_LAT, reach_lon=BOX_LON,
    )
    distance = equirect_m(F.col(lat), F.col(lon), F.col("stop_lat"), F.col("stop_lon"))
    return pairs.withColumn("distance_m", distance).filter(F.col("distance_m") < radius_m)


def segments_near_cells(
    cells: DataFrame,
    segments: DataFrame,
    order: Sequence[str],
    *,
    grid: float = GRID_SIZE,
    per_cell: int | None = None,
    max_cells: int | None = None,
) -> DataFrame:
    """Segments that start within two grid steps of a cell.

    A caller who pays per segment passes limits: at most ``per_cell`` segments,
    first by ``order``, for the first ``max_cells`` cells.
    """
    if max_cells is not None:
        cells = cells.orderBy("lat", "lon").limit(max_cells)
    near = within_box(
        cells, segments, lat="lat", lon="lon", target_lat="origin_lat", target_lon="origin_lon",
        reach_lat=2 * grid, reach_lon=2 * grid,
    )
    if per_cell is None:
        return near
    return top_per_key(near, ["lat", "lon"], [F.asc(c) for c in order], per_cell)


def nearest_stops_to(
    stops: DataFrame, lat: float, lon: float, k: int = 5
) -> DataFrame:
    """The ``k`` stops nearest to one place (a top-k, no full sort)."""
    distance = equirect_m(F.lit(lat), F.lit(lon), F.col("stop_lat"), F.col("stop_lon"))
    return (
        stops.withColumn("distance_m", distance)
        .orderBy("distance_m", "stop_id")
        .limit(k)
        .withColumn("distance_m", F.round("distance_m", 1))
    )


def nearest_stops(
    points: DataFrame,
    stops: DataFrame,
    k: int = 5,
    *,
    key: str = "point_id",
    lat: str = "lat",
    lon: str = "lon",
    finest: float = FINEST,
    levels: int = 18,
) -> DataFrame:
    """The ``k`` stops nearest to every point of a table, exactly.

    Stops are counted on nested grids, each cell three times as wide (in
    degrees) as one of the level below; the finest are smaller than a metre, so
    a crowded place is told apart too, and the coarsest spans the world.  A point
    searches on the finest level where the 3 x 3 cells around it hold ``k``
    stops.  Its k-th neighbour is then no farther than the diagonal of two
    cells, so the few cells within that reach hold all answers.  Only if the
    whole map has fewer than ``k`` stops is there no such level; then all of
    them are the answer.

    Levels and candidates are worked out per cell, not per point, and every
    point is joined once.  Of stops at one and the same place only the first
    ``k`` ids can matter, so a pile of copies is cut down before the join.
    """
    places = distinct_on_place(stops, k)

    def up(cell: Column, level: Column) -> Column:
        return F.floor(cell / F.pow(F.lit(3.0), level)).cast("long")

    every_level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")

    def on_levels(df: DataFrame, y: str, x: str) -> DataFrame:
        return df.select("*", every_level).select(
            "*", up(F.col(y), F.col("level")).alias("cy"), up(F.col(x), F.col("level")).alias("cx")
        )

    def with_cell(df: DataFrame, y: str, x: str) -> DataFrame:
        return df.withColumns(
            {"__y": bucket(F.col(y), finest), "__x": bucket(F.col(x), finest)}
        )

    located = with_cell(places, "stop_lat", "stop_lon")
    asked = with_cell(
        points.select(key, F.col(lat).alias("__lat"), F.col(lon).alias("__lon")),
        "__lat", "__lon",
    )
    rings = (
        on_levels(located.groupBy("__y", "__x").agg(F.count(F.lit(1)).alias("n")), "__y", "__x")
        .groupBy("level", "cy", "cx")
        .agg(F.sum("n").alias("n"))
        .withColumn("cy", F.explode(F.sequence(F.col("cy") - 1, F.col("cy") + 1)))
        .withColumn("cx", F.explode(F.sequence(F.col("cx") - 1, F.col("cx") + 1)))
        .groupBy("level", "cy", "cx")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= k)
    )
    homes = (
        on_levels(asked.select("__y", "__x").distinct(), "__y", "__x")
        .join(rings, ["level", "cy", "cx"], "left")
        .groupBy("__y", "__x")
        .agg(
            F.coalesce(
                F.min(F.when(F.col("n").isNotNull(), F.col("level"))), F.lit(levels - 1)
            ).alias("level")
        )
        .select(
            "__y", "__x", "level",
            up(F.col("__y"), F.col("level")).alias("home_y"),
            up(F.col("__x"), F.col("level")).alias("home_x"),
        )
    )
    # East-west a degree is shorter, so the same distance spans 1 / cos(lat)
    # times as many cells; the edge farther from the equator decides.
    size = F.lit(finest) * F.pow(F.lit(3.0), F.col("level"))
    edge = F.least(
        F.greatest(F.abs(F.col("home_y")), F.abs(F.col("home_y") + 1)) * size, F.lit(89.0)
    )
    diagonal = 2 * 2**0.5
    reach_x = F.ceil(F.lit(diagonal) / F.cos(F.radians(edge))).cast("long")
    search = (
        homes.select("level", "home_y", "home_x")
        .distinct()
        .withColumn("cy", F.explode(F.sequence(F.col("home_y") - 3, F.col("home_y") + 3)))
        .withColumn(
            "cx",
            F.explode(F.sequence(F.col("home_x") - reach_x, F.col("home_x") + reach_x)),
        )
    )
    candidates = (
        search.join(on_levels(located, "__y", "__x"), ["level", "cy", "cx"])
        .select("level", "home_y", "home_x", *places.columns)
    )
    distance = equirect_m(F.col("__lat"), F.col("__lon"), F.col("stop_lat"), F.col("stop_lon"))
    found = (
        asked.join(homes, ["__y", "__x"])
        .join(candidates, ["level", "home_y", "home_x"])
        .withColumn("distance_m", distance)
    )
    window = Window.partitionBy(key).orderBy("distance_m", "stop_id")
    return (
        found.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= k)
        .select(key, "rank", *places.columns, F.round("distance_m", 1).alias("distance_m"))
    )


def distinct_on_place(stops: DataFrame, k: int) -> DataFrame:
    """The first ``k`` stops by id at every exact place."""
    return top_per_key(stops, ["stop_lat", "stop_lon"], [F.asc("stop_id")], k)
