"""Queries over the static schedule, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.query import CTES, query, rounded
from headway.functions.labels import (
    corridor_type_label,
    default_if_blank,
    route_type_label,
)
from headway.functions.times import departure_hour, gtfs_seconds
from headway.operators.distinct import distinct_counts, distinct_sketches, merge_sketches
from headway.operators.latest import latest_snapshot
from headway.operators.quality import (
    STOP_KEY,
    cast_columns,
    expect,
    filter_route,
    non_terminal,
    plausible_segments,
    select_except,
    table_counts,
    violation_counts,
)
from headway.operators.scd import scd1, scd2, versions_at
from headway.operators.schedule import (
    route_frequency,
    route_hourly_profile,
    route_hourly_trips,
    schedule_window,
    segment_distance,
    stop_frequency,
    stop_segments,
    with_route_labels,
    with_stop_ends,
)
from headway.operators.shapes import (
    longest_shape,
    polyline_parts,
    route_geometries,
    route_polylines,
    shape_route_bridge,
    shape_summary,
)
from headway.plans.schedule import route_shapes, scheduled_times

SECONDS = (
    "CAST(split_part({0}, ':', 1) AS INTEGER) * 3600 + CAST(split_part({0}, ':', 2) AS INTEGER)"
    " * 60 + CAST(split_part({0}, ':', 3) AS INTEGER)"
)
HOUR = "CAST(split_part({0}, ':', 1) AS INTEGER)"
TYPE_NAME = (
    "CASE {0} WHEN 1 THEN 'subway' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus' WHEN 4 THEN 'ferry'"
    " ELSE 'other' END"
)

CTES["g_legs"] = """
    SELECT gtfs_snapshot_date, trip_id, stop_id AS origin_stop_id, departure_time, stop_sequence,
           shape_dist_traveled AS origin_dist,
           LEAD(stop_id) OVER along AS dest_stop_id,
           LEAD(arrival_time) OVER along AS dest_arrival_time,
           LEAD(stop_sequence) OVER along AS dest_stop_sequence,
           LEAD(shape_dist_traveled) OVER along AS dest_dist
    FROM g_stop_times
    WINDOW along AS (PARTITION BY gtfs_snapshot_date, trip_id ORDER BY stop_sequence)"""
CTES["g_segments"] = f"""
    SELECT route_id, route_short_name AS route_name, route_long_name,
           {TYPE_NAME.format("route_type")} AS route_type, trip_headsign, direction_id, service_id,
           origin_stop_id, o.stop_name AS origin_stop_name, o.stop_lat AS origin_lat,
           o.stop_lon AS origin_lon, dest_stop_id, d.stop_name AS dest_stop_name,
           d.stop_lat AS dest_lat, d.stop_lon AS dest_lon, stop_sequence, departure_time,
           dest_arrival_time AS arrival_time,
           ({SECONDS.format("dest_arrival_time")}) - ({SECONDS.format("departure_time")})
               AS scheduled_segment_seconds,
           {rounded("COALESCE(dest_dist, 0) - COALESCE(origin_dist, 0)", 3)}
               AS segment_distance_km,
           {HOUR.format("departure_time")} AS departure_hour, gtfs_snapshot_date
    FROM g_legs JOIN g_trips USING (gtfs_snapshot_date, trip_id) JOIN g_routes USING (route_id)
    LEFT JOIN g_stops o ON o.stop_id = origin_stop_id
    LEFT JOIN g_stops d ON d.stop_id = dest_stop_id
    WHERE dest_stop_id IS NOT NULL"""
CTES["g_calls"] = """
    SELECT trip_id, arrival_time, departure_time, stop_id, stop_sequence, route_id,
           route_short_name, shape_id
    FROM g_stop_times JOIN g_trips USING (trip_id) JOIN g_routes USING (route_id)"""
CTES["g_bridge"] = """
    SELECT DISTINCT shape_id, route_id, route_short_name, route_long_name, route_type, route_color
    FROM g_trips JOIN g_routes USING (route_id)"""
CTES["g_changes"] = """
    SELECT *, LAG(stop_name) OVER line AS was_name, LAG(zone_id) OVER line AS was_zone,
           ROW_NUMBER() OVER line AS nth
    FROM g_snapshots WINDOW line AS (PARTITION BY stop_id ORDER BY gtfs_snapshot_date)"""
CTES["g_history"] = """
    SELECT stop_id, stop_name, zone_id, gtfs_snapshot_date AS __START_AT,
           LEAD(gtfs_snapshot_date) OVER (PARTITION BY stop_id ORDER BY gtfs_snapshot_date)
               AS __END_AT
    FROM g_changes
    WHERE nth = 1 OR stop_name IS DISTINCT FROM was_name OR zone_id IS DISTINCT FROM was_zone"""


# --- projections, filters, functions -------------------------------------------------

@query("cast_columns", """
    SELECT trip_id, TRY_CAST(route_id AS INTEGER) AS route_id,
           TRY_CAST(service_id AS INTEGER) AS service_id,
           TRY_CAST(direction_id AS BIGINT) AS direction_id
    FROM g_trips""")
def _(t):
    return cast_columns(
        t.trips,
        {"trip_id": "string", "route_id": "int", "service_id": "int", "direction_id": "bigint"},
    )


@query("route_type_label", f"""
    SELECT route_id, {TYPE_NAME.format("route_type")} AS label FROM g_routes""")
def _(t):
    return t.routes.select("route_id", route_type_label(F.col("route_type")).alias("label"))


@query("corridor_type_label", """
    SELECT p_partkey,
           CASE p_size WHEN 0 THEN 'tram' WHEN 1 THEN 'subway' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus'
                       WHEN 4 THEN 'ferry' ELSE 'bus' END AS label
    FROM part""")
def _(t):
    return t.raw("part").select(
        "p_partkey", corridor_type_label(F.col("p_size")).alias("label")
    )


@query("gtfs_seconds", f"""
    SELECT trip_id, stop_sequence, {SECONDS.format("departure_time")} AS seconds,
           {HOUR.format("departure_time")} AS hour, {HOUR.format("departure_time")} % 24
               AS hour_wrapped
    FROM g_stop_times""")
def _(t):
    clock = F.col("departure_time")
    return t.stop_times.select(
        "trip_id", "stop_sequence", gtfs_seconds(clock).alias("seconds"),
        departure_hour(clock).alias("hour"), departure_hour(clock, wrap=True).alias("hour_wrapped"),
    )


@query("default_fill", """
    SELECT route_id, CASE WHEN route_color IS NULL OR route_color = '' THEN '0000FF'
                          ELSE route_color END AS route_color,
           COALESCE(CASE WHEN route_type <> 1 THEN route_short_name END, 'SkyTrain')
               AS route_name
    FROM g_routes""")
def _(t):
    name = F.when(F.col("route_type") != 1, F.col("route_short_name"))
    return t.routes.select(
        "route_id", default_if_blank(F.col("route_color"), "0000FF").alias("route_color"),
        default_if_blank(name, "SkyTrain").alias("route_name"),
    )


@query("select_except", "SELECT stop_id, stop_name, zone_id FROM g_snapshots")
def _(t):
    return select_except(t.snapshots, "gtfs_snapshot_date", "_source_file")


@query("latest_snapshot", """
    SELECT * FROM g_snapshots
    WHERE gtfs_snapshot_date = (SELECT MAX(gtfs_snapshot_date) FROM g_snapshots)""")
def _(t):
    return latest_snapshot(t.snapshots)


@query("snapshot_dates", "SELECT DISTINCT gtfs_snapshot_date FROM g_snapshots")
def _(t):
    return t.snapshots.select("gtfs_snapshot_date").distinct()


@query("expect_drop", "SELECT * FROM g_stops WHERE stop_id IS NOT NULL AND stop_lat BETWEEN 49 AND 49.2")
def _(t):
    return expect(t.stops, {**STOP_KEY, "south": "stop_lat BETWEEN 49 AND 49.2"})


@query("expect_counts", """
    SELECT COUNT(*) FILTER (NOT (stop_lat BETWEEN 48 AND 50)) AS latitude_in_area,
           COUNT(*) FILTER (NOT (stop_lon BETWEEN -124 AND -123)) AS longitude_in_west
    FROM g_stops""")
def _(t):
    return violation_counts(
        t.stops,
        {
            "latitude_in_area": "stop_lat BETWEEN 48 AND 50",
            "longitude_in_west": "stop_lon BETWEEN -124 AND -123",
        },
    )


@query("plausible_segments", """
    SELECT route_id, origin_stop_id, dest_stop_id, stop_sequence, departure_time,
           scheduled_segment_seconds
    FROM g_segments WHERE scheduled_segment_seconds > 0 AND scheduled_segment_seconds < 300""")
def _(t):
    return plausible_segments(t.segments, hi=300).select(
        "route_id", "origin_stop_id", "dest_stop_id", "stop_sequence", "departure_time",
        "scheduled_segment_seconds",
    )


@query("non_terminal", """
    SELECT trip_id, stop_sequence, dest_stop_id FROM g_legs WHERE dest_stop_id IS NOT NULL""")
def _(t):
    return non_terminal(stop_segments(t.stop_times)).select(
        "trip_id", "stop_sequence", "dest_stop_id"
    )


@query("segment_distance", f"""
    SELECT trip_id, stop_sequence,
           {rounded("COALESCE(dest_dist, 0) - COALESCE(origin_dist, 0)", 3)} AS km
    FROM g_legs""")
def _(t):
    return stop_segments(t.stop_times).select(
        "trip_id", "stop_sequence", segment_distance().alias("km")
    )


@query("schedule_window", f"""
    SELECT trip_id, stop_sequence, departure_time FROM g_stop_times
    WHERE {HOUR.format("departure_time")} BETWEEN 8 AND 10""")
def _(t):
    return schedule_window(t.stop_times, 8).select("trip_id", "stop_sequence", "departure_time")


@query("filter_route", """
    SELECT stop_id, COUNT(*) AS calls FROM g_calls
    WHERE LOWER(route_short_name) = '007' GROUP BY stop_id""")
def _(t):
    return filter_route(t.calls, "007").groupBy("stop_id").agg(F.count("*").alias("calls"))


@query("table_counts", """
    SELECT 'routes' AS tbl, COUNT(*) AS cnt FROM g_routes
    UNION ALL SELECT 'stops', COUNT(*) FROM g_stops
    UNION ALL SELECT 'trips', COUNT(*) FROM g_trips
    UNION ALL SELECT 'stop_times', COUNT(*) FROM g_stop_times
    UNION ALL SELECT 'shapes', COUNT(*) FROM g_shapes""")
def _(t):
    names = ("routes", "stops", "trips", "stop_times", "shapes")
    return table_counts({name: getattr(t, name) for name in names})


# --- windows and joins ---------------------------------------------------------------

@query("stop_segments", "SELECT * FROM g_legs")
def _(t):
    return stop_segments(t.stop_times)


@query("segments_with_trips_and_routes", f"""
    SELECT trip_id, stop_sequence, route_id, direction_id, route_short_name
    FROM g_legs JOIN g_trips USING (gtfs_snapshot_date, trip_id) JOIN g_routes USING (route_id)""")
def _(t):
    return with_route_labels(stop_segments(t.stop_times), t.trips, t.routes).select(
        "trip_id", "stop_sequence", "route_id", "direction_id", "route_short_name"
    )


@query("segments_with_stops", """
    SELECT trip_id, stop_sequence, o.stop_name AS origin_stop_name, d.stop_name AS dest_stop_name
    FROM g_legs LEFT JOIN g_stops o ON o.stop_id = origin_stop_id
    LEFT JOIN g_stops d ON d.stop_id = dest_stop_id""")
def _(t):
    return with_stop_ends(stop_segments(t.stop_times), t.stops).select(
        "trip_id", "stop_sequence", "origin_stop_name", "dest_stop_name"
    )


@query("scheduled_times", "SELECT * FROM g_segments")
def _(t):
    return t.segments


@query("serving_stop_times", "SELECT * FROM g_calls")
def _(t):
    return t.calls


@query("stop_frequency", f"""
    WITH hourly AS (
        SELECT stop_id, {HOUR.format("departure_time")} AS hour_of_day,
               COUNT(DISTINCT trip_id) AS trip_count
        FROM g_stop_times GROUP BY 1, 2),
    ranked AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY stop_id
                                     ORDER BY trip_count DESC, hour_of_day) AS place
        FROM hourly),
    daily AS (SELECT stop_id, COUNT(DISTINCT trip_id) AS trips_per_day
              FROM g_stop_times GROUP BY 1)
    SELECT h.stop_id, stop_name, stop_lat, stop_lon, h.hour_of_day, h.trip_count, trips_per_day,
           r.hour_of_day AS peak_hour, r.trip_count AS peak_trips
    FROM hourly h JOIN ranked r ON r.stop_id = h.stop_id AND r.place = 1
    JOIN daily ON daily.stop_id = h.stop_id JOIN g_stops s ON s.stop_id = h.stop_id""")
def _(t):
    return stop_frequency(t.stop_times, t.stops)


@query("route_frequency", f"""
    SELECT route_short_name AS route_name, route_id, COUNT(DISTINCT trip_id) AS trips,
           COUNT(DISTINCT stop_id) AS stops_served, MIN(shape_id) AS sample_shape_id
    FROM g_calls WHERE {HOUR.format("departure_time")} = 8 AND route_short_name IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return route_frequency(t.calls, 8)


@query("route_hourly_trips", f"""
    SELECT route_id, {HOUR.format("departure_time")} AS hour, COUNT(DISTINCT trip_id) AS trips
    FROM g_calls WHERE {HOUR.format("departure_time")} BETWEEN 5 AND 24 GROUP BY 1, 2""")
def _(t):
    return route_hourly_trips(t.calls)


@query("route_hourly_profile", f"""
    SELECT route_id, string_agg(hour || ':' || trips, ',' ORDER BY hour) AS profile
    FROM (SELECT route_id, {HOUR.format("departure_time")} AS hour,
                 COUNT(DISTINCT trip_id) AS trips
          FROM g_calls WHERE {HOUR.format("departure_time")} BETWEEN 5 AND 24 GROUP BY 1, 2)
    GROUP BY route_id""")
def _(t):
    text = F.transform("hourly_profile", lambda e: F.concat_ws(":", e["hour"], e["trips"]))
    return route_hourly_profile(t.calls).select(
        "route_id", F.array_join(text, ",").alias("profile")
    )


# --- history -------------------------------------------------------------------------

@query("scd1", """
    SELECT stop_id, stop_name, zone_id
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY stop_id ORDER BY gtfs_snapshot_date DESC)
                 AS place FROM g_snapshots) WHERE place = 1""")
def _(t):
    return scd1(t.snapshots, ["stop_id"], "gtfs_snapshot_date", drop=["gtfs_snapshot_date"])


@query("versions_at", """
    SELECT o_orderkey, o_orderdate, stop_id, stop_name, zone_id
    FROM (SELECT o_orderkey, o_orderdate, CAST(o_custkey AS STRING) AS stop_id,
                 CAST(YEAR(o_orderdate) AS STRING) AS held_in FROM orders) AS asked
    LEFT JOIN g_history USING (stop_id)
    WHERE __START_AT <= held_in AND (__END_AT IS NULL OR held_in < __END_AT)""")
def _(t):
    asked = t.raw("orders").select(
        "o_orderkey", "o_orderdate", F.col("o_custkey").cast("string").alias("stop_id"),
        F.year("o_orderdate").cast("string").alias("held_in"),
    )
    return versions_at(asked, t.history, ["stop_id"], "held_in").drop("held_in")


@query("scheduled_times_at_date", f"""
    WITH moved AS (
        SELECT stop_id, stop_name || ' old' AS stop_name, stop_lat + 1e0 AS stop_lat, stop_lon,
               '2024-01-05' AS date_from, '2024-01-12' AS date_to FROM g_stops
        UNION ALL SELECT stop_id, stop_name, stop_lat, stop_lon, '2024-01-12', '9999-12-31' FROM g_stops),
    legs AS (
        SELECT gtfs_snapshot_date, trip_id, stop_sequence, departure_time, stop_id AS origin_stop_id,
               LEAD(stop_id) OVER (PARTITION BY gtfs_snapshot_date, trip_id ORDER BY stop_sequence) AS dest_stop_id
        FROM g_feed_stop_times)
    SELECT gtfs_snapshot_date, route_id, trip_headsign, stop_sequence, departure_time, origin_stop_id,
           o.stop_name AS origin_stop_name, o.stop_lat AS origin_lat,
           dest_stop_id, d.stop_name AS dest_stop_name, d.stop_lat AS dest_lat
    FROM legs JOIN g_feed_trips USING (gtfs_snapshot_date, trip_id) JOIN g_routes USING (route_id)
    LEFT JOIN moved o ON o.stop_id = origin_stop_id AND o.date_from <= gtfs_snapshot_date AND gtfs_snapshot_date < o.date_to
    LEFT JOIN moved d ON d.stop_id = dest_stop_id AND d.date_from <= gtfs_snapshot_date AND gtfs_snapshot_date < d.date_to
    WHERE dest_stop_id IS NOT NULL""")
def _(t):
    newest = t.stops.drop("location_type").withColumn("gtfs_snapshot_date", F.lit("2024-01-12"))
    older = newest.withColumns(
        {
            "stop_name": F.concat("stop_name", F.lit(" old")), "stop_lat": F.col("stop_lat") + 1,
            "gtfs_snapshot_date": F.lit("2024-01-05"),
        }
    )
    history = scd2(newest.unionByName(older), ["stop_id"], "gtfs_snapshot_date")
    return scheduled_times(t.feed_stop_times, t.feed_trips, t.routes, history, all_snapshots=True).select(
        "gtfs_snapshot_date", "route_id", "trip_headsign", "stop_sequence", "departure_time",
        "origin_stop_id", "origin_stop_name", "origin_lat", "dest_stop_id", "dest_stop_name", "dest_lat",
    )


@query("distinct_trips_sketched", f"""
    SELECT route_id, {HOUR.format("departure_time")} AS hour, COUNT(DISTINCT trip_id) AS trips, TRUE AS near
    FROM g_calls GROUP BY ALL""")
def _(t):
    """Daily sketches added up, beside the exact counts: no estimate is off by 3 %."""
    calls = t.calls.select(
        "route_id", "trip_id", departure_hour(F.col("departure_time")).alias("hour"),
        (F.col("trip_id").cast("bigint") % 7).alias("day"),
    )
    by_day = distinct_sketches(calls, ["route_id", "hour", "day"], ["trip_id"])
    merged = merge_sketches(by_day, ["route_id", "hour"], ["trip_id"])
    estimates = distinct_counts(merged, ["trip_id"]).withColumnRenamed("trip_id", "estimate")
    exact = calls.groupBy("route_id", "hour").agg(F.count_distinct("trip_id").alias("trips"))
    near = F.abs(F.col("estimate") - F.col("trips")) <= 0.03 * F.col("trips")
    return exact.join(estimates, ["route_id", "hour"]).select("route_id", "hour", "trips", near.alias("near"))


@query("scd2", "SELECT * FROM g_history")
def _(t):
    return t.history


@query("current_versions", """
    SELECT stop_id, stop_name, zone_id FROM g_history WHERE __END_AT IS NULL""")
def _(t):
    return t.current


# --- shapes --------------------------------------------------------------------------

@query("shape_summary", """
    SELECT s.shape_id, COUNT(*) AS num_points, MAX(shape_dist_traveled) AS total_distance_km,
           ARG_MIN(shape_pt_lat, shape_pt_sequence) AS start_lat,
           ARG_MIN(shape_pt_lon, shape_pt_sequence) AS start_lon,
           MIN(shape_pt_lat) AS min_lat, MAX(shape_pt_lat) AS max_lat,
           MIN(shape_pt_lon) AS min_lon, MAX(shape_pt_lon) AS max_lon
    FROM g_shapes s GROUP BY s.shape_id""")
def _(t):
    return shape_summary(t.shapes)


@query("shape_route_bridge", "SELECT * FROM g_bridge")
def _(t):
    return shape_route_bridge(t.trips, t.routes)


@query("route_shapes", f"""
    WITH sized AS (
        SELECT shape_id, COUNT(*) AS num_points, MAX(shape_dist_traveled) AS km,
               ARG_MIN(shape_pt_lat, shape_pt_sequence) AS start_lat,
               ARG_MIN(shape_pt_lon, shape_pt_sequence) AS start_lon,
               MIN(shape_pt_lat) AS min_lat, MAX(shape_pt_lat) AS max_lat,
               MIN(shape_pt_lon) AS min_lon, MAX(shape_pt_lon) AS max_lon
        FROM g_shapes GROUP BY shape_id)
    SELECT shape_id, route_id, route_short_name AS route_name, route_long_name, num_points,
           {rounded("km", 2)} AS total_distance_km, start_lat, start_lon,
           min_lat, max_lat, min_lon, max_lon
    FROM sized JOIN g_bridge USING (shape_id)""")
def _(t):
    return route_shapes(t.shapes, t.trips, t.routes)


@query("longest_shape", """
    WITH sized AS (SELECT shape_id, COUNT(*) AS points FROM g_shapes GROUP BY 1),
    ranked AS (SELECT route_id, shape_id, points,
                      ROW_NUMBER() OVER (PARTITION BY route_id
                                         ORDER BY points DESC, shape_id DESC) AS place
               FROM g_bridge JOIN sized USING (shape_id))
    SELECT route_id, shape_id, points FROM ranked WHERE place = 1""")
def _(t):
    return longest_shape(t.shapes, t.trips)


POINTS = (
    "string_agg(CAST(CAST(shape_pt_lon AS DECIMAL(12,6)) AS VARCHAR) || ' ' ||"
    " CAST(CAST(shape_pt_lat AS DECIMAL(12,6)) AS VARCHAR), ',' ORDER BY shape_pt_sequence)"
)


def points_text(coordinates):
    def fixed(value):
        return value.cast("decimal(12,6)").cast("string")

    return F.array_join(
        F.transform(coordinates, lambda p: F.concat_ws(" ", fixed(p[0]), fixed(p[1]))), ","
    )


@query("polyline_parts", f"""
    SELECT shape_id, CAST(FLOOR(shape_pt_sequence / 16) AS INTEGER) AS part, {POINTS} AS points
    FROM g_shapes GROUP BY 1, 2""")
def _(t):
    return polyline_parts(t.shapes, points=16).select(
        "shape_id", "part", points_text(F.col("coordinates")).alias("points")
    )


@query("route_polylines", f"""
    WITH lines AS (SELECT shape_id, {POINTS} AS points FROM g_shapes GROUP BY 1)
    SELECT shape_id, route_short_name, route_long_name, route_type,
           COALESCE(NULLIF(route_color, ''), '0000FF') AS route_color, points
    FROM lines JOIN g_bridge USING (shape_id)""")
def _(t):
    return route_polylines(t.feed_shapes, t.feed_trips, t.routes).withColumn(
        "points", points_text(F.col("coordinates"))
    ).drop("coordinates")


@query("route_geometries", f"""
    WITH lines AS (SELECT shape_id, {POINTS} AS points, COUNT(*) AS n FROM g_shapes GROUP BY 1)
    SELECT shape_id, route_short_name AS route_name, route_long_name, route_type,
           COALESCE(NULLIF(route_color, ''), '0000FF') AS route_color, n, points
    FROM lines JOIN g_bridge USING (shape_id)""")
def _(t):
    stored = t.polylines.withColumn("coordinates", F.to_json("coordinates"))
    return route_geometries(stored).select(
        "shape_id", "route_name", "route_long_name", "route_type", "route_color",
        F.size("coordinates").cast("bigint").alias("n"), points_text(F.col("coordinates")).alias("points"),
    )
