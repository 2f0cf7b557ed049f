"""Queries that answer riders, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F


from checks.map_queries import flat
from checks.query import CTES, query, rounded
from checks.schedule_queries import HOUR, POINTS, SECONDS, points_text
from headway.operators.latest import distinct_on
from headway.operators.schedule import stop_frequency
from headway.plans.service import (
    direct_departures,
    frequency_for,
    stops_served_by,
    top_corridors,
    trip_plan,
)


@query("stops_served_by", """
    SELECT * FROM g_stops
    WHERE stop_id IN (SELECT stop_id FROM g_calls WHERE route_short_name = '007')""")
def _(t):
    return stops_served_by(t.stops, t.calls, "007")


@query("frequency_for", f"""
    SELECT stop_id, stop_name, COUNT(DISTINCT trip_id) AS trips
    FROM g_stop_times JOIN g_stops USING (stop_id)
    WHERE {HOUR.format("departure_time")} = 9
      AND stop_id IN (SELECT stop_id FROM g_calls WHERE route_short_name = '011')
    GROUP BY 1, 2""")
def _(t):
    frequency = stop_frequency(t.stop_times, t.stops)
    return frequency_for(frequency, 9, t.calls, "011").select(
        "stop_id", "stop_name", F.col("trip_count").alias("trips")
    )


@query("distinct_on", f"""
    SELECT route_short_name, departure_time, trip_id, stop_sequence FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY route_short_name, departure_time
                                     ORDER BY trip_id, stop_sequence) AS place
        FROM g_calls) WHERE place = 1""")
def _(t):
    return distinct_on(
        t.calls, ["route_short_name", "departure_time"], ["trip_id", "stop_sequence"]
    ).select("route_short_name", "departure_time", "trip_id", "stop_sequence")


@query("top_corridors", f"""
    WITH busiest AS (
        SELECT route_short_name AS route, route_id, COUNT(DISTINCT trip_id) AS trips_per_hour,
               COUNT(DISTINCT stop_id) AS stops_served, MIN(shape_id) AS shape_id
        FROM g_calls WHERE {HOUR.format("departure_time")} = 8 AND route_short_name IS NOT NULL
        GROUP BY 1, 2 ORDER BY trips_per_hour DESC, route, route_id LIMIT 10),
    hourly AS (
        SELECT route_id, {HOUR.format("departure_time")} AS hour,
               COUNT(DISTINCT trip_id) AS trips
        FROM g_calls WHERE {HOUR.format("departure_time")} BETWEEN 5 AND 24 GROUP BY 1, 2),
    profiles AS (
        SELECT route_id, string_agg(hour || ':' || trips, ',' ORDER BY hour) AS profile
        FROM hourly GROUP BY 1),
    lines AS (SELECT shape_id, {POINTS} AS points FROM g_shapes GROUP BY 1)
    SELECT route, b.route_id, trips_per_hour, stops_served, COALESCE(route_long_name, '')
               AS long_name,
           COALESCE(NULLIF(route_color, ''), '0000FF') AS color, points, profile
    FROM busiest b LEFT JOIN (lines JOIN g_bridge USING (shape_id)) l USING (shape_id)
    LEFT JOIN profiles p ON p.route_id = b.route_id""")
def _(t):
    profile = F.transform("hourly_profile", lambda e: F.concat_ws(":", e["hour"], e["trips"]))
    return top_corridors(t.calls, t.polylines, 8).select(
        "route", "route_id", "trips_per_hour", "stops_served", "long_name", "color",
        points_text(F.col("coordinates")).alias("points"),
        F.array_join(profile, ",").alias("profile"),
    )


def near(side: str) -> str:
    return f"""
        SELECT request_id, hour, stop_id, stop_name, stop_lat, stop_lon
        FROM g_requests JOIN g_stops
          ON ABS(stop_lat - {side}_lat) < 0.008 AND ABS(stop_lon - {side}_lon) < 0.012
        WHERE {flat(f"{side}_lat", f"{side}_lon", "stop_lat", "stop_lon")} < 800"""


CTES["g_departures"] = f"""
    WITH os AS ({near("origin")}), ds AS ({near("dest")}),
    pairs AS (
        SELECT os.request_id, COALESCE(o.route_short_name, o.route_id) AS route, o.route_id, o.trip_id,
               o.departure_time AS board_time, d.arrival_time AS alight_time,
               os.stop_name AS board_stop, ds.stop_name AS alight_stop,
               os.stop_lat AS board_lat, os.stop_lon AS board_lon,
               ds.stop_lat AS alight_lat, ds.stop_lon AS alight_lon,
               ROW_NUMBER() OVER (
                   PARTITION BY os.request_id, COALESCE(o.route_short_name, o.route_id), o.departure_time
                   ORDER BY o.trip_id, o.stop_sequence, o.stop_id, d.stop_sequence, d.stop_id)
                   AS place
        FROM g_calls o JOIN os ON os.stop_id = o.stop_id
        JOIN g_calls d ON d.trip_id = o.trip_id AND d.stop_sequence > o.stop_sequence
        JOIN ds ON ds.stop_id = d.stop_id AND ds.request_id = os.request_id
        WHERE {HOUR.format("o.departure_time")} BETWEEN os.hour AND os.hour + 2)
    SELECT * EXCLUDE (place) FROM pairs WHERE place = 1"""


@query("direct_departures", "SELECT * FROM g_departures")
def _(t):
    return direct_departures(t.calls, t.stops, t.requests).drop("stop_sequence")


@query("trip_plan", f"""
    WITH first AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id, route
                                     ORDER BY {SECONDS.format("board_time")}, board_time) AS place
        FROM g_departures)
    SELECT * EXCLUDE (place),
           {rounded(f"GREATEST(({SECONDS.format('alight_time')}) - "
                    f"({SECONDS.format('board_time')}), 0) / 60", 1)} AS duration_min
    FROM first WHERE place = 1""")
def _(t):
    return trip_plan(t.calls, t.stops, t.requests)
