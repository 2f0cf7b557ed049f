"""Declared input schemas.  Nothing is inferred, so a scan never reads twice."""

from __future__ import annotations

from pyspark.sql import types as T

# GTFS file columns and their types, as public feeds publish them.
GTFS_COLUMNS: dict[str, str] = {
    "agency": (
        "agency_id STRING, agency_name STRING, agency_url STRING, agency_timezone STRING, "
        "agency_lang STRING, agency_phone STRING, agency_fare_url STRING"
    ),
    "calendar": (
        "service_id STRING, monday INT, tuesday INT, wednesday INT, thursday INT, friday INT, "
        "saturday INT, sunday INT, start_date STRING, end_date STRING"
    ),
    "calendar_dates": "service_id STRING, date STRING, exception_type INT",
    "routes": (
        "route_id STRING, agency_id STRING, route_short_name STRING, route_long_name STRING, "
        "route_desc STRING, route_type INT, route_url STRING, route_color STRING, "
        "route_text_color STRING"
    ),
    "shapes": (
        "shape_id STRING, shape_pt_lat DOUBLE, shape_pt_lon DOUBLE, shape_pt_sequence INT, "
        "shape_dist_traveled DOUBLE"
    ),
    "stops": (
        "stop_id STRING, stop_code STRING, stop_name STRING, stop_desc STRING, stop_lat DOUBLE, "
        "stop_lon DOUBLE, zone_id STRING, stop_url STRING, location_type INT, "
        "parent_station STRING, wheelchair_boarding INT"
    ),
    "stop_times": (
        "trip_id STRING, arrival_time STRING, departure_time STRING, stop_id STRING, "
        "stop_sequence INT, stop_headsign STRING, pickup_type INT, drop_off_type INT, "
        "shape_dist_traveled DOUBLE, timepoint INT"
    ),
    "trips": (
        "route_id STRING, service_id STRING, trip_id STRING, trip_headsign STRING, "
        "trip_short_name STRING, direction_id INT, block_id STRING, shape_id STRING, "
        "wheelchair_accessible INT, bikes_allowed INT"
    ),
    "transfers": (
        "from_stop_id STRING, to_stop_id STRING, transfer_type INT, min_transfer_time INT"
    ),
    "feed_info": (
        "feed_publisher_name STRING, feed_publisher_url STRING, feed_lang STRING, "
        "feed_start_date STRING, feed_end_date STRING, feed_version STRING"
    ),
}

TRAFFIC_READING = (
    "corridor_id STRING, corridor_name STRING, origin_lat DOUBLE, origin_lng DOUBLE, "
    "dest_lat DOUBLE, dest_lng DOUBLE, duration_seconds INT, static_duration_seconds INT, "
    "distance_meters INT, congestion_ratio DOUBLE, api_response_json STRING, polled_at TIMESTAMP"
)

CORRIDOR = (
    "corridor_id STRING, corridor_name STRING, corridor_type STRING, zone STRING, "
    "speed_limit_kmh INT, num_lanes INT, route_id STRING, route_short_name STRING, "
    "distance_km DOUBLE, origin STRUCT<lat: DOUBLE, lng: DOUBLE>, "
    "destination STRUCT<lat: DOUBLE, lng: DOUBLE>"
)

WAYPOINT = (
    "origin_lat DOUBLE, origin_lon DOUBLE, dest_lat DOUBLE, dest_lon DOUBLE, shape_id STRING, "
    "waypoint_no INT, route_name STRING"
)

ROUTE_RESPONSE = (
    "routes ARRAY<STRUCT<duration: STRING, staticDuration: STRING, distanceMeters: INT, "
    "polyline: STRUCT<encodedPolyline: STRING>, "
    "travelAdvisory: STRUCT<speedReadingIntervals: ARRAY<STRUCT<"
    "startPolylinePointIndex: INT, endPolylinePointIndex: INT, speed: STRING>>>>>"
)

def ddl(schema: str) -> T.StructType:
    """Parsed form of a DDL string."""
    return T.StructType.fromDDL(schema)
