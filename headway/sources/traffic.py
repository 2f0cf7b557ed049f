"""Traffic poll files, corridor lists and the files exported for pollers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.schemas import CORRIDOR, TRAFFIC_READING, WAYPOINT, ddl
from headway.sources.gtfs import with_file_metadata


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """All poll files as one batch, raw rows kept."""
    return with_file_metadata(spark.read.schema(TRAFFIC_READING).json(path), arrival=True)


def stream_traffic(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of poll files, new files only."""
    reader = spark.readStream.schema(TRAFFIC_READING)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_file_metadata(reader.json(path), arrival=True)


def append_poll_json(poll: DataFrame, path: str) -> None:
    """Add one poll to the folder that the stream watches."""
    poll.write.mode("append").json(path)


def corridor_records(
    spark: SparkSession, path: str | None = None, json: str | None = None
) -> DataFrame:
    """Corridor records as listed: a JSON array, or one record per line as ``export_corridors`` writes."""
    if json:
        texts = spark.range(1).select(F.lit(json).alias("value"))
    elif path:
        texts = spark.read.text(path, wholetext=True)
    else:
        raise ValueError("give either a path or inline JSON")
    text = F.trim("value")
    lines = F.concat(F.lit("["), F.regexp_replace(text, r"\}\s*\n\s*\{", "},{"), F.lit("]"))
    array = F.when(F.startswith(text, F.lit("[")), text).otherwise(lines)
    return texts.select(F.inline(F.from_json(array, T.ArrayType(ddl(CORRIDOR)))))


def read_corridors(
    spark: SparkSession, path: str | None = None, json: str | None = None
) -> DataFrame:
    """Corridor list from files or from inline JSON, coordinates flattened."""
    listed = corridor_records(spark, path, json)
    return listed.select(
        *[c for c in listed.columns if c not in ("origin", "destination")],
        F.col("origin.lat").alias("origin_lat"), F.col("origin.lng").alias("origin_lng"),
        F.col("destination.lat").alias("dest_lat"), F.col("destination.lng").alias("dest_lng"),
    )


def export_corridors(corridors: DataFrame, path: str) -> None:
    corridors.write.mode("overwrite").json(path)


def export_waypoints(route_segments: DataFrame, path: str) -> None:
    """Origin and destination pairs for pollers, as JSON lines.

    ``waypoint_no`` keeps the order along the shape for ``corridors_from_waypoints``.
    """
    route_segments.select(
        "origin_lat", "origin_lon", "dest_lat", "dest_lon", "shape_id",
        F.col("shape_pt_sequence").alias("waypoint_no"),
        F.col("route_short_name").alias("route_name"),
    ).write.mode("overwrite").json(path)


def read_waypoints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WAYPOINT).json(path)
