"""Composite tables of live congestion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.times import day_of_week, hour_key, hour_of_day, quarter_key, route_key
from headway.operators.latest import dedupe_segments, missing_keys
from headway.operators.quality import filter_route
from headway.operators.ranges import segments_near_cells
from headway.operators.vehicles import slow_cells

# Fixed value: how long answers for arterials count.
ARTERIAL_TTL = "15 minutes"

# Morning and evening peak hours, hours looked ahead.
PEAK_HOURS = ((6, 10), (15, 19))
HOURS_AHEAD = 2

SEGMENT_ORDER = ("shape_id", "shape_pt_sequence", "route_id")


def slow_corridor_targets(
    grid: DataFrame,
    segments: DataFrame,
    *,
    order: tuple[str, ...] = SEGMENT_ORDER,
    per_cell: int | None = None,
    max_cells: int | None = None,
    max_targets: int | None = None,
) -> DataFrame:
    """Route segments near slow cells, each once.

    The limits are for callers who pay for every look-up; without them all are given.
    """
    cells = slow_cells(grid).select("lat", "lon", "level", "avg_speed")
    near = segments_near_cells(
        cells, segments, order, per_cell=per_cell, max_cells=max_cells
    )
    ranked = ["lat", "lon", *order]
    once = dedupe_segments(near, ranked)
    if max_targets is not None:
        once = once.orderBy(*ranked).limit(max_targets)
    return once.select(
        "origin_lat", "origin_lon", "dest_lat", "dest_lon",
        F.col("route_short_name").alias("route_name"),
        F.col("level").alias("trigger"),
        F.col("avg_speed").alias("bus_speed"),
    )


def combine_congestion(layers: Mapping[str, DataFrame]) -> DataFrame:
    """All layers in one table; ``source`` names the layer a row comes from.

    A row that already has a source keeps it.
    """
    tagged = [
        df.withColumn("source", F.coalesce("source", F.lit(name)))
        if "source" in df.columns
        else df.withColumn("source", F.lit(name))
        for name, df in layers.items()
    ]
    total = tagged[0]
    for layer in tagged[1:]:
        total = total.unionByName(layer, allowMissingColumns=True)
    return total


def live_congestion(layers: Mapping[str, DataFrame], route: str | None = None) -> DataFrame:
    """Combined layers, or only the painted pieces of one route."""
    if route is None:
        return combine_congestion(layers)
    painted = {name: df for name, df in layers.items() if name == "bus_route"}
    return filter_route(combine_congestion(painted), route, "route")


def congestion_at(
    painted: DataFrame,
    arterial: DataFrame,
    cache: DataFrame,
    *,
    now: Column,
    hour: int,
    day: int,
    live: bool = False,
    route: str | None = None,
    queried_at: str = "queried_at",
) -> DataFrame:
    """What is known of congestion at a moment, each row with the layer it comes from.

    ``cache`` holds the segments of answered look-ups under their ``cache_key``.
    A route outside live mode is answered from the cache under its own key
    (``google_route``), in live mode by its painted pieces.  Without a route
    there are, in live mode, all painted pieces and the arterial answers of the
    last 15 minutes, and always the cached answers of the quarter hour
    (``google_targeted``) and of the hour (``google`` unless they say otherwise).
    """
    hour_, day_ = F.lit(hour), F.lit(day)

    def under(key: Column) -> DataFrame:
        return cache.filter(F.col("cache_key") == key).drop("cache_key")

    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("source", F.lit(name))

    if route is not None and not live:
        known = tagged(under(route_key(hour_, day_, F.lit(route))), "google_route")
        return known.withColumn("routes", F.array(F.lit(route)))
    if route is not None:
        return tagged(painted.filter(F.lower("route") == route.lower()), "bus_route")
    quarter = (F.floor(F.minute(now) / 15) * 15).cast("int").cast("string")
    cached = {
        "google_targeted": tagged(
            under(F.concat(hour_key(hour_, day_), F.lit("_q"), quarter)), "google_targeted"
        ),
        "google": under(hour_key(hour_, day_)),
    }
    if not live:
        return combine_congestion(cached)
    fresh = arterial.filter(F.col(queried_at) > now - F.expr(f"INTERVAL '{ARTERIAL_TTL}'"))
    shown = {
        "bus_route": tagged(painted, "bus_route"),
        "google_arterial": tagged(fresh.drop(queried_at), "google_arterial"),
    }
    return combine_congestion({**shown, **cached})


def quarter_hour_readings(readings: DataFrame, ts: str = "polled_at", tz: str | None = None):
    """Readings per 15-minute bucket and its key; works on streams with a watermark."""
    return (
        readings.groupBy(F.window(ts, "15 minutes").alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.avg("congestion_ratio").alias("avg_congestion_ratio"),
        )
        .select(
            F.col("bucket.start").alias("bucket_start"),
            quarter_key(F.col("bucket.start"), tz).alias("cache_key"),
            "readings", "avg_congestion_ratio",
        )
    )


def peak_keys_to_fill(
    moments: DataFrame, cache: DataFrame, ts: str = "now", tz: str | None = None
) -> DataFrame:
    """Hourly keys of the peak hours that come next after each moment and that
    the cache does not hold."""
    hour, day = hour_of_day(F.col(ts), tz), day_of_week(F.col(ts), tz)
    ahead = F.explode(F.sequence(F.lit(1), F.lit(HOURS_AHEAD)))
    upcoming = moments.select(hour.alias("now_hour"), day.alias("day")).distinct().select(
        "day", "now_hour", ahead.alias("ahead")
    ).withColumn("hour", (F.col("now_hour") + F.col("ahead")) % 24)
    (first_am, last_am), (first_pm, last_pm) = PEAK_HOURS
    peak = F.col("hour").between(first_am, last_am) | F.col("hour").between(first_pm, last_pm)
    wanted = upcoming.filter(peak).select(
        hour_key(F.col("hour"), F.col("day")).alias("cache_key"), "hour", "day"
    ).distinct()
    return missing_keys(wanted, cache, ["cache_key"])
