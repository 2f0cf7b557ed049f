"""Traffic segments out of stored routing responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.responses import (
    decode_polyline,
    parse_duration,
    parsed_response,
    traffic_level,
)


def traffic_segments(responses: DataFrame, *, json: str = "api_response_json") -> DataFrame:
    """One row per speed interval of every route in every response.

    All intervals of a response carry the level of the whole response and
    their own speed.  An interval that points past the polyline has no
    coordinates.  A route without intervals gives one row from origin to
    destination.
    """
    routes = responses.withColumn("route", F.explode(parsed_response(F.col(json))["routes"])).drop(
        json
    )
    listed = routes.select(
        *[c for c in routes.columns if c != "route"],
        F.coalesce("route.travelAdvisory.speedReadingIntervals", F.array()).alias("intervals"),
        F.coalesce(parse_duration(F.col("route.duration")), F.lit(0)).alias("duration"),
        F.coalesce("route.distanceMeters", F.lit(0)).alias("distance"),
        # Decoded once per route, below the explode.
        decode_polyline(F.coalesce("route.polyline.encodedPolyline", F.lit(""))).alias("points"),
    )
    ends = ["origin_lat", "origin_lon", "dest_lat", "dest_lon"]
    kept = [c for c in listed.columns if c not in {*ends, "intervals", "points"}]
    none = F.size("intervals") == 0
    spread = listed.select(
        *kept, *ends, "points", none.alias("plain"),
        F.when(none, "LOW").otherwise(traffic_level(F.col("intervals"))).alias("level"),
        F.posexplode_outer("intervals").alias("place", "reading"),
    )
    first = F.coalesce("reading.startPolylinePointIndex", F.lit(0))
    last = F.coalesce("reading.endPolylinePointIndex", first + 1)
    start = {c: F.get(F.col("points")[c], first) for c in ("lat", "lon")}
    end = {c: F.coalesce(F.get(F.col("points")[c], last), start[c]) for c in ("lat", "lon")}
    plain = F.col("plain")
    return spread.select(
        *kept, F.coalesce("place", F.lit(0)).alias("interval"),
        *[F.when(plain, F.col(f"origin_{c}")).otherwise(start[c]).alias(f"start_{c}") for c in ("lat", "lon")],
        *[F.when(plain, F.col(f"dest_{c}")).otherwise(end[c]).alias(f"end_{c}") for c in ("lat", "lon")],
        "level",
        F.when(plain, "UNKNOWN").otherwise(F.coalesce("reading.speed", F.lit("NORMAL"))).alias("speed"),
        F.lit(1).alias("samples"),
    )


def level_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("level").agg(F.count(F.lit(1)).alias("segments"))
