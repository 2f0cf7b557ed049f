"""Table sinks: full overwrite, and the three tables that lookups are served from."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def serving_routes(polylines: DataFrame, feed_date: str) -> DataFrame:
    """Polylines with their coordinates as JSON text and the date they are from."""
    return polylines.withColumn("coordinates", F.to_json("coordinates")).withColumn(
        "feed_date", F.lit(feed_date)
    )


def serving_stops(stops: DataFrame, feed_date: str) -> DataFrame:
    return stops.select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type",
        F.lit(feed_date).alias("feed_date"),
    )


def serving_segments(route_segments: DataFrame) -> DataFrame:
    return route_segments.select(
        "shape_id", "origin_lat", "origin_lon", "dest_lat", "dest_lon", "route_short_name"
    )


SERVING = ("routes", "stops", "route_segments")
_EDITIONS = "editions"


def publish_serving(
    routes: DataFrame, stops: DataFrame, segments: DataFrame, path: str, feed_date: str
) -> None:
    """Publish the serving tables as one; executors write, nothing passes the driver.

    The three tables go to a folder of a new edition. Its row in the list of
    editions is written last, so readers see all three of it or none.
    """
    edition = f"{feed_date}_{time.time_ns()}"
    for name, df in zip(SERVING, (serving_routes(routes, feed_date), serving_stops(stops, feed_date), serving_segments(segments))):
        save_table(df, f"{path}/{edition}/{name}")
    listed = routes.sparkSession.range(1).select(F.lit(edition).alias("edition"), F.current_timestamp().alias("published_at"))
    listed.write.mode("append").parquet(f"{path}/{_EDITIONS}")


def serving_editions(spark: SparkSession, path: str) -> list[str]:
    """Published editions, the newest feed and publication first: one short text each."""
    listed = spark.read.parquet(f"{path}/{_EDITIONS}")
    order = [F.split_part("edition", F.lit("_"), F.lit(1)), F.split_part("edition", F.lit("_"), F.lit(2)).cast("long")]
    return [name for (name,) in listed.orderBy(*[F.desc(c) for c in order]).select("edition").collect()]


def read_serving(spark: SparkSession, path: str, edition: str | None = None) -> dict[str, DataFrame]:
    """The three tables of one edition, the newest by default."""
    edition = serving_editions(spark, path)[0] if edition is None else edition
    return {name: spark.read.parquet(f"{path}/{edition}/{name}") for name in SERVING}
