"""Transit-shaped inputs over the generated test tables.

The library knows nothing of these tables.  Each view is one SQL text, run by
Spark here and reused as a common table expression in the oracle queries; only
the epoch function and the table references differ between the engines.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.scd import current_versions, scd2
from headway.operators.schedule import serving_stop_times
from headway.operators.shapes import route_polylines
from headway.operators.vehicles import drop_unlocated, grid_congestion, vehicle_speeds
from headway.plans.predict import hourly_profiles, seasonal_factors
from headway.plans.schedule import route_segments, scheduled_times
from headway.plans.traffic import schedule_vs_actual, traffic_readings

SNAPSHOT_DATE, OLDER_DATE = "2024-01-12", "2024-01-05"


def _clock(seconds: str) -> str:
    def two(value: str) -> str:
        return f"lpad(CAST({value} AS STRING), 2, '0')"

    hours = two(f"CAST(FLOOR(({seconds}) / 3600) AS INT)")
    minutes = two(f"CAST(FLOOR((({seconds}) % 3600) / 60) AS INT)")
    return f"{hours} || ':' || {minutes} || ':' || {two(f'({seconds}) % 60')}"


# Table names are written [name]; {SEC} is the engine's epoch expression.
VIEWS: dict[str, str] = {
    "g_routes": """
        SELECT CAST(n_nationkey AS STRING) AS route_id,
               CASE WHEN n_nationkey <> 23 THEN lpad(CAST(n_nationkey AS STRING), 3, '0') END
                   AS route_short_name,
               n_name AS route_long_name, n_nationkey % 5 AS route_type,
               CASE n_regionkey WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'FF000' || n_regionkey END
                   AS route_color
        FROM [nation]""",
    "g_stops": """
        SELECT CAST(s_suppkey AS STRING) AS stop_id, s_name AS stop_name,
               49.0e0 + (s_suppkey % 97) * 0.004e0 AS stop_lat,
               -123.2e0 + (s_suppkey % 89) * 0.006e0 AS stop_lon,
               CAST(s_nationkey % 2 AS INT) AS location_type
        FROM [supplier]""",
    "g_trips": f"""
        SELECT CAST(o_orderkey AS STRING) AS trip_id,
               CAST(o_custkey % 25 AS STRING) AS route_id,
               CAST((o_custkey % 25) * 2 + o_orderkey % 2 AS STRING) AS shape_id,
               o_orderpriority AS service_id, o_orderstatus AS trip_headsign,
               CAST(o_orderkey % 2 AS INT) AS direction_id,
               '{SNAPSHOT_DATE}' AS gtfs_snapshot_date
        FROM [orders]""",
    "g_shapes": """
        SELECT CAST(p_partkey % 50 AS STRING) AS shape_id,
               CAST(FLOOR(p_partkey / 50) AS INT) AS shape_pt_sequence,
               49.1e0 + FLOOR(p_partkey / 50) * 0.001e0 + (p_partkey % 7) * 0.0001e0
                   AS shape_pt_lat,
               -123.1e0 + FLOOR(p_partkey / 50) * 0.0015e0 + p_size * 0.00001e0 AS shape_pt_lon,
               FLOOR(p_partkey / 50) * 0.15e0 AS shape_dist_traveled
        FROM [part]""",
    "g_stop_times": f"""
        SELECT CAST(l_orderkey AS STRING) AS trip_id, l_linenumber AS stop_sequence,
               CAST(sk AS STRING) AS stop_id,
               {_clock("a")} AS arrival_time, {_clock("a + 20")} AS departure_time,
               l_linenumber * 0.5e0 AS shape_dist_traveled,
               '{SNAPSHOT_DATE}' AS gtfs_snapshot_date
        FROM (SELECT l_orderkey, l_linenumber, sk,
                     CAST((l_orderkey % 21 + 5) * 3600 + l_linenumber * 300 + pk % 120 AS BIGINT)
                         AS a
              FROM (SELECT l_orderkey, l_linenumber, MIN(l_suppkey) AS sk, MIN(l_partkey) AS pk
                    FROM [lineitem] GROUP BY l_orderkey, l_linenumber) AS calls) AS timed""",
    "g_traffic": """
        SELECT corridor_id, 'Corridor ' || corridor_id AS corridor_name, polled_at,
               _file_arrival_time, event_id, static_duration_seconds,
               CAST(FLOOR(st * (0.9e0 + value / 100)) AS INT) AS duration_seconds,
               FLOOR(st * (0.9e0 + value / 100)) / st AS congestion_ratio,
               CAST(event_id % 5000 + 500 AS INT) AS distance_meters, api_response_json
        FROM (SELECT 'route_' || lpad(CAST(user_id % 25 AS STRING), 3, '0') || '_seg_'
                         || CAST(event_id % 3 + 1 AS STRING) AS corridor_id,
                     date_trunc('hour', ts) AS polled_at, ts AS _file_arrival_time, event_id,
                     value, CAST(300 + event_id % 600 AS INT) AS st,
                     CAST(300 + event_id % 600 AS INT) AS static_duration_seconds,
                     CASE WHEN event_type = 'error' THEN '{"error": "x"}' ELSE props END
                         AS api_response_json
              FROM [events]) AS polls""",
    "g_snapshots": """
        SELECT stop_id, gtfs_snapshot_date, stop_name, zone_id
        FROM (SELECT CAST(o_custkey AS STRING) AS stop_id,
                     CAST(YEAR(o_orderdate) AS STRING) AS gtfs_snapshot_date,
                     o_orderpriority AS stop_name, o_orderstatus AS zone_id,
                     ROW_NUMBER() OVER (PARTITION BY o_custkey, YEAR(o_orderdate)
                                        ORDER BY o_orderdate DESC, o_orderkey DESC) AS pick
              FROM [orders]) AS yearly
        WHERE pick = 1""",
    "g_positions": """
        SELECT CAST(user_id AS STRING) AS id, {SEC} / 360 AS ts,
               49.1e0 + (user_id % 40) * 0.003e0 + (FLOOR(value) % 10) * 0.0003e0 AS lat,
               -123.1e0 + (user_id % 25) * 0.004e0 + (event_id % 5) * 0.0003e0 AS lon,
               CAST(user_id % 25 AS STRING) AS route_id,
               lpad(CAST(user_id % 25 AS STRING), 3, '0') AS route,
               value * 3.7e0 AS bearing,
               CASE WHEN event_type = 'signup' THEN value * 0.1e0 END AS speed, event_id
        FROM [events]""",
    # One stored routing response per event, with three speed intervals or none.
    "g_responses": """
        SELECT event_id, 49.1e0 + (event_id % 40) * 0.003e0 AS origin_lat,
               -123.1e0 + (event_id % 25) * 0.004e0 AS origin_lon,
               49.2e0 + (event_id % 50) * 0.002e0 AS dest_lat,
               -123.0e0 + (event_id % 35) * 0.003e0 AS dest_lon,
               '{"routes":[{"duration":"' || CAST(300 + event_id % 700 AS STRING)
               || 's","staticDuration":"' || CAST(event_id % 500 AS STRING)
               || 's","distanceMeters":' || CAST(500 + event_id % 5000 AS STRING)
               || ',"polyline":{"encodedPolyline":"'
               || CASE event_id % 4 WHEN 0 THEN '_p~iF~ps|U_ulLnnqC_mqNvxq`@' WHEN 1 THEN ''
                       WHEN 2 THEN '_p~iF~ps|U_ulLnnqC' ELSE '_p~iF~ps|Ué' END || '"}'
               || CASE WHEN event_type = 'view' THEN '' ELSE
                  ',"travelAdvisory":{"speedReadingIntervals":['
                  || '{"endPolylinePointIndex":1,"speed":"'
                  || CASE WHEN event_type = 'click' THEN 'TRAFFIC_JAM' ELSE 'SLOW' END || '"},'
                  || '{"startPolylinePointIndex":1,"endPolylinePointIndex":2,"speed":"'
                  || CASE WHEN event_id % 2 = 0 THEN 'TRAFFIC_JAM' ELSE 'NORMAL' END || '"},'
                  || '{"startPolylinePointIndex":2,"endPolylinePointIndex":3}'
                  || ']}' END || '}]}' AS api_response_json
        FROM [events]""",
    # One rider request per customer.
    "g_requests": """
        SELECT c_custkey AS request_id,
               49.0e0 + (c_custkey * 7919 % 10007) * 0.00003811e0 AS origin_lat,
               -123.2e0 + (c_custkey * 104729 % 10009) * 0.00005233e0 AS origin_lon,
               49.0e0 + (c_custkey * 1299709 % 10037) * 0.00003797e0 AS dest_lat,
               -123.2e0 + (c_custkey * 15485863 % 10039) * 0.00005261e0 AS dest_lon,
               CAST(5 + c_custkey % 20 AS INT) AS hour
        FROM [customer]""",
    # A cache of answered lookups, one entry per event user and hour.
    "g_cache": """
        SELECT CAST(HOUR(ts) AS STRING) || '_' || CAST(user_id % 7 + 1 AS STRING) AS cache_key,
               CAST(HOUR(ts) AS INT) AS hour_of_day, CAST(user_id % 7 + 1 AS INT) AS day_of_week,
               props AS segments_json, ts AS last_accessed_at, event_id
        FROM [events]""",
}


# Feeds of two snapshots: the newest one, and an older one with other times, trips and points.
def _dated(name: str, columns: str, older: str) -> str:
    newest = f"SELECT {columns}, '{SNAPSHOT_DATE}' AS gtfs_snapshot_date FROM ({VIEWS[name]}) AS now"
    return f"{newest} UNION ALL SELECT {older}, '{OLDER_DATE}' FROM ({VIEWS[name]}) AS before"


VIEWS["g_feed_stop_times"] = _dated(
    "g_stop_times",
    "trip_id, stop_sequence, stop_id, arrival_time, departure_time, shape_dist_traveled",
    "trip_id, stop_sequence + 1, stop_id, arrival_time, '04:00:00', shape_dist_traveled + 1e0",
)
VIEWS["g_feed_trips"] = _dated(
    "g_trips",
    "trip_id, route_id, shape_id, service_id, trip_headsign, direction_id",
    "trip_id, CAST((direction_id + 3) % 25 AS STRING), shape_id, service_id, 'old', direction_id",
)
VIEWS["g_feed_shapes"] = _dated(
    "g_shapes",
    "shape_id, shape_pt_sequence, shape_pt_lat, shape_pt_lon, shape_dist_traveled",
    "shape_id, shape_pt_sequence, shape_pt_lat + 0.5e0, shape_pt_lon, shape_dist_traveled",
)


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace("{SEC}", "unix_timestamp(ts)")
    for table in set(re.findall(r"\[(\w+)\]", text)):
        text = text.replace(f"[{table}]", f"parquet.`{sf_dir}/{table}.parquet`")
    return spark.sql(text)


def duckdb_view(name: str) -> str:
    text = VIEWS[name].replace("{SEC}", "FLOOR(epoch(ts))")
    return re.sub(r"\[(\w+)\]", r"\1", text)


class Tables:
    """Views and the library's own intermediate tables for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if f"g_{name}" not in VIEWS:
            raise AttributeError(name)
        return spark_view(self.spark, self.sf_dir, f"g_{name}")

    @cached_property
    def readings(self) -> DataFrame:
        return traffic_readings(self.traffic, newest=("_file_arrival_time", "event_id"))

    @cached_property
    def segments(self) -> DataFrame:
        return scheduled_times(self.feed_stop_times, self.feed_trips, self.routes, self.stops)

    @cached_property
    def comparison(self) -> DataFrame:
        return schedule_vs_actual(self.segments, self.readings)

    @cached_property
    def history(self) -> DataFrame:
        return scd2(self.snapshots, ["stop_id"], "gtfs_snapshot_date")

    @cached_property
    def current(self) -> DataFrame:
        return current_versions(self.history)

    @cached_property
    def calls(self) -> DataFrame:
        return serving_stop_times(self.feed_stop_times, self.feed_trips, self.routes)

    @cached_property
    def polylines(self) -> DataFrame:
        return route_polylines(self.feed_shapes, self.feed_trips, self.routes)

    @cached_property
    def speeds(self) -> DataFrame:
        return vehicle_speeds(drop_unlocated(self.positions), tie_break=["event_id"])

    @cached_property
    def grid(self) -> DataFrame:
        return grid_congestion(self.speeds)

    @cached_property
    def route_segments(self) -> DataFrame:
        return route_segments(self.feed_shapes, self.feed_trips, self.routes)

    @cached_property
    def profiles(self) -> DataFrame:
        return hourly_profiles(self.readings)

    @cached_property
    def factors(self) -> DataFrame:
        return seasonal_factors(self.readings)

    @cached_property
    def shape_labels(self) -> DataFrame:
        """Shapes with the label that vehicles show."""
        return self.trips.select("shape_id", "route_id").distinct().select(
            "shape_id", F.lpad("route_id", 3, "0").alias("route")
        )
