"""Queries over vehicles, shapes, corridors and places, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.query import CTES, half_even, query, rounded
from headway.functions.geo import equirect_m, grid_cell, haversine_km
from headway.functions.labels import congestion_level, corridor_id, corridor_name, speed_limit
from headway.functions.responses import parsed_response, traffic_level
from headway.operators.corridors import (
    arterial_corridors,
    corridors_by_type,
    evenly_spaced_segments,
    select_routes,
)
from headway.operators.latest import dedupe_segments, latest_positions
from headway.operators.ordered import (
    consecutive_pairs,
    sample_every_nth,
    stratified_sample,
    strided_pick,
    with_position,
)
from headway.operators.ranges import (
    nearest_stops,
    nearest_stops_to,
    segments_near_cells,
    stops_within,
)
from headway.operators.vehicles import (
    drop_unlocated,
    grid_totals,
    label_vehicles,
    paint_routes,
    route_speeds,
    slow_cells,
)
from headway.plans.corridors import corridors_from_shapes, corridors_from_waypoints
from headway.functions.times import hour_key, route_key
from headway.plans.live import (
    combine_congestion,
    congestion_at,
    live_congestion,
    slow_corridor_targets,
)
from headway.plans.segments import level_counts, traffic_segments


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371.0e0 * atan2(sqrt({chord}), sqrt(1 - {chord})))"


def flat(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(111320.0e0 * sqrt(pow({lat2} - {lat1}, 2)"
        f" + pow(({lon2} - {lon1}) * cos(radians({lat1})), 2)))"
    )


LEVEL = "CASE WHEN {0} < 8 THEN 'HIGH' WHEN {0} < 15 THEN 'MEDIUM' ELSE 'LOW' END"

CTES["g_located"] = f"""
    SELECT id, ts, {rounded("lat", 6)} AS lat, {rounded("lon", 6)} AS lon, route_id, route,
           {rounded("bearing", 1)} AS bearing,
           CASE WHEN speed <> 0 THEN {rounded("speed * 3.6", 1)} END AS speed, event_id
    FROM g_positions WHERE lat IS NOT NULL AND lat <> 0"""
CTES["g_moves"] = """
    SELECT *, ts - LAG(ts) OVER own AS gap, LAG(lat) OVER own AS was_lat,
           LAG(lon) OVER own AS was_lon
    FROM g_located WINDOW own AS (PARTITION BY id ORDER BY ts, event_id)"""
CTES["g_speeds"] = f"""
    SELECT * FROM (
        SELECT id, ts, lat, lon, route_id, route, bearing, speed, event_id,
               CASE WHEN speed > 0 THEN speed
                    WHEN gap > 5 AND gap < 120
                         AND {haversine("was_lat", "was_lon", "lat", "lon")} > 0.005
                    THEN {rounded(haversine("was_lat", "was_lon", "lat", "lon")
                                  + " / (gap / 3600)", 1)} END AS speed_kmh
        FROM g_moves)
    WHERE speed_kmh < 80"""
CTES["g_grid"] = f"""
    WITH cells AS (
        SELECT round_even(lat / 0.003e0, 0) * 0.003e0 AS lat,
               round_even(lon / 0.003e0, 0) * 0.003e0 AS lon,
               CAST(SUM(CAST(speed_kmh AS DECIMAL(10,1))) AS DOUBLE) / COUNT(*) AS average,
               COUNT(*) AS count, string_agg(DISTINCT route, ',' ORDER BY route) AS routes
        FROM g_speeds GROUP BY 1, 2)
    SELECT lat, lon, {rounded("average", 1)} AS avg_speed, {LEVEL.format("average")} AS level,
           count, routes
    FROM cells"""
CTES["g_route_speeds"] = """
    SELECT route, CAST(SUM(CAST(speed_kmh AS DECIMAL(10,1))) AS DOUBLE) / COUNT(*) AS avg_speed,
           COUNT(*) AS samples
    FROM g_speeds WHERE route <> '' GROUP BY route"""
CTES["g_placed"] = """
    SELECT *, ROW_NUMBER() OVER (PARTITION BY shape_id ORDER BY shape_pt_sequence) - 1 AS position,
           COUNT(*) OVER (PARTITION BY shape_id) AS size
    FROM g_shapes"""
CTES["g_sampled"] = """
    SELECT *, LEAD(shape_pt_lat) OVER along AS next_lat, LEAD(shape_pt_lon) OVER along AS next_lon
    FROM g_placed WHERE position % 10 = 0
    WINDOW along AS (PARTITION BY shape_id ORDER BY shape_pt_sequence)"""
CTES["g_route_segments"] = """
    SELECT shape_id, shape_pt_lat AS origin_lat, shape_pt_lon AS origin_lon,
           next_lat AS dest_lat, next_lon AS dest_lon, shape_pt_sequence,
           route_id, route_short_name, route_long_name, route_type
    FROM g_sampled JOIN g_bridge USING (shape_id) WHERE next_lat IS NOT NULL"""
CTES["g_longest"] = """
    SELECT route_id, shape_id
    FROM (SELECT route_id, shape_id,
                 ROW_NUMBER() OVER (PARTITION BY route_id ORDER BY n DESC, shape_id DESC) AS place
          FROM g_bridge JOIN (SELECT shape_id, COUNT(*) AS n FROM g_shapes GROUP BY 1)
               USING (shape_id))
    WHERE place = 1"""
CTES["g_even"] = """
    SELECT a.shape_id, i AS segment, a.size AS points, a.shape_pt_lat AS origin_lat,
           a.shape_pt_lon AS origin_lon, b.shape_pt_lat AS dest_lat, b.shape_pt_lon AS dest_lon
    FROM g_placed a JOIN (SELECT UNNEST([0, 1, 2]) AS i) picks
      ON a.position = i * GREATEST(1, a.size // 4)
    JOIN g_placed b ON b.shape_id = a.shape_id
      AND b.position = LEAST((i + 1) * GREATEST(1, a.size // 4), a.size - 1)
    WHERE a.position < b.position"""
PRIORITY = (
    "'099','99','R1','R2','R3','R4','R5','009','9','014','14','025','25','041','41','049','49',"
    "'003','3','008','8','019','19','020','20'"
)
CTES["g_near"] = """
    SELECT c.lat, c.lon, c.level, c.avg_speed, s.*
    FROM g_grid c JOIN g_route_segments s
      ON ABS(s.origin_lat - c.lat) < 0.006e0 AND ABS(s.origin_lon - c.lon) < 0.006e0
    WHERE c.level IN ('HIGH', 'MEDIUM')"""
CORRIDOR_COLUMNS = """
           'route_' || route_short_name || '_seg_' || number AS corridor_id,
           route_short_name || ' ' || route_long_name || ' (segment ' || number || ')'
               AS corridor_name,
           CASE route_type WHEN 0 THEN 'tram' WHEN 1 THEN 'subway' WHEN 2 THEN 'rail'
                WHEN 4 THEN 'ferry' ELSE 'bus' END AS corridor_type, route_id, route_short_name,
           'Metro Vancouver' AS zone,
           CASE WHEN route_type IN (0, 1, 2, 4) THEN 80 ELSE 50 END AS speed_limit_kmh,
           2 AS num_lanes, origin_lat, origin_lon, dest_lat, dest_lon"""
KM = haversine("origin_lat", "origin_lon", "dest_lat", "dest_lon")


def flattened(corridors):
    return corridors.select(
        *[c for c in corridors.columns if c not in ("origin", "destination")],
        F.col("origin.lat").alias("origin_lat"), F.col("origin.lng").alias("origin_lon"),
        F.col("destination.lat").alias("dest_lat"), F.col("destination.lng").alias("dest_lon"),
    )


# --- distances and cells -------------------------------------------------------------

@query("distances", f"""
    SELECT request_id,
           {rounded(haversine("origin_lat", "origin_lon", "dest_lat", "dest_lon"), 6)} AS km,
           {rounded(flat("origin_lat", "origin_lon", "dest_lat", "dest_lon"), 3)} AS meters
    FROM g_requests""")
def _(t):
    ends = [F.col(c) for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon")]
    return t.requests.select(
        "request_id", F.round(haversine_km(*ends), 6).alias("km"),
        F.round(equirect_m(*ends), 3).alias("meters"),
    )


@query("grid_cell", """
    SELECT event_id, round_even(lat / 0.003e0, 0) * 0.003e0 AS lat,
           round_even(lon / 0.003e0, 0) * 0.003e0 AS lon FROM g_positions""")
def _(t):
    return t.positions.select(
        "event_id", grid_cell(F.col("lat")).alias("lat"), grid_cell(F.col("lon")).alias("lon")
    )


@query("congestion_level", f"SELECT event_id, {LEVEL.format('value')} AS level FROM events")
def _(t):
    return t.raw("events").select("event_id", congestion_level(F.col("value")).alias("level"))


# --- vehicles ------------------------------------------------------------------------

@query("drop_unlocated", "SELECT * FROM g_located")
def _(t):
    return drop_unlocated(t.positions)


@query("label_vehicles", """
    SELECT event_id, route_id, COALESCE(route_short_name, route_id) AS route
    FROM g_positions LEFT JOIN g_routes USING (route_id)""")
def _(t):
    return label_vehicles(t.positions.drop("route"), t.routes).select("event_id", "route_id", "route")


@query("latest_positions", """
    SELECT id, event_id FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS place
        FROM g_positions) WHERE place = 1""")
def _(t):
    return latest_positions(t.positions, tie_break=["event_id"]).select("id", "event_id")


@query("vehicle_speeds", "SELECT * FROM g_speeds")
def _(t):
    return t.speeds


@query("grid_congestion", "SELECT * FROM g_grid")
def _(t):
    return t.grid.withColumn("routes", F.array_join("routes", ","))


@query("route_speeds", "SELECT * FROM g_route_speeds")
def _(t):
    return route_speeds(t.speeds)


@query("slow_cells", "SELECT lat, lon, level FROM g_grid WHERE level IN ('HIGH', 'MEDIUM')")
def _(t):
    return slow_cells(t.grid).select("lat", "lon", "level")


@query("grid_totals", """
    SELECT COUNT(*) AS total, COUNT(*) FILTER (level IN ('HIGH', 'MEDIUM')) AS slow
    FROM g_grid""")
def _(t):
    return grid_totals(t.grid)


CTES["g_painted"] = f"""
    WITH corners AS (
        SELECT *, GREATEST(1, size // 30) AS step FROM g_placed)
    SELECT lpad(l.route_id, 3, '0') AS route, a.shape_id, a.position // a.step AS piece,
           a.shape_pt_lon AS start_lon, a.shape_pt_lat AS start_lat,
           b.shape_pt_lon AS end_lon, b.shape_pt_lat AS end_lat,
           {LEVEL.format("avg_speed")} AS level,
           {rounded("avg_speed", 1)} || ' km/h' AS speed, 'bus_route' AS source, samples
    FROM corners a
    JOIN corners b ON b.shape_id = a.shape_id AND b.position = a.position + a.step
    JOIN g_longest l ON l.shape_id = a.shape_id
    JOIN g_route_speeds v ON v.route = lpad(l.route_id, 3, '0')
    WHERE a.position % a.step = 0"""


@query("paint_routes", "SELECT * FROM g_painted")
def _(t):
    return paint_routes(route_speeds(t.speeds), t.shapes, t.shape_labels)


# --- samples and pairs along shapes --------------------------------------------------

@query("with_position", "SELECT * FROM g_placed")
def _(t):
    return with_position(t.shapes, ["shape_id"], "shape_pt_sequence", size="size", width=16)


@query("sample_every_nth", """
    SELECT shape_id, shape_pt_sequence, position FROM g_placed WHERE position % 10 = 0""")
def _(t):
    return sample_every_nth(t.shapes, ["shape_id"], "shape_pt_sequence", 10).select(
        "shape_id", "shape_pt_sequence", "position"
    )


@query("consecutive_pairs", """
    SELECT shape_id, CAST(position / 10 AS BIGINT) AS nth, shape_pt_lat, shape_pt_lon,
           next_lat, next_lon
    FROM g_sampled WHERE next_lat IS NOT NULL""")
def _(t):
    sampled = sample_every_nth(t.shapes, ["shape_id"], "shape_pt_sequence", 10).select(
        "shape_id", (F.col("position") / 10).cast("long").alias("nth"), "shape_pt_lat",
        "shape_pt_lon",
    )
    return consecutive_pairs(sampled, ["shape_id"], "nth", "shape_pt_lat", "shape_pt_lon")


@query("route_segments", "SELECT * FROM g_route_segments")
def _(t):
    return t.route_segments


@query("stratified_sample", """
    WITH named AS (SELECT * REPLACE (COALESCE(route_short_name, 'unknown') AS route_short_name)
                   FROM g_route_segments),
    placed AS (
        SELECT shape_id, shape_pt_sequence, route_short_name,
               ROW_NUMBER() OVER own - 1 AS position,
               COUNT(*) OVER (PARTITION BY route_short_name) AS n,
               GREATEST(1, 40 // (SELECT COUNT(DISTINCT route_short_name) FROM named)) AS share
        FROM named
        WINDOW own AS (PARTITION BY route_short_name ORDER BY shape_id, shape_pt_sequence)),
    strided AS (SELECT *, GREATEST(1, n // LEAST(share, n)) AS stride FROM placed)
    SELECT route_short_name, shape_id, shape_pt_sequence FROM strided
    WHERE position % stride = 0 AND position // stride < share""")
def _(t):
    return stratified_sample(
        t.route_segments, "route_short_name", "shape_pt_sequence", major=["shape_id"], cap=40
    ).select("route_short_name", "shape_id", "shape_pt_sequence")


@query("strided_pick", """
    WITH placed AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY shape_id ORDER BY shape_pt_sequence) - 1 AS p,
               COUNT(*) OVER (PARTITION BY shape_id) AS n FROM g_shapes),
    picks AS (SELECT UNNEST(range(7)) AS i)
    SELECT shape_id, shape_pt_sequence, CASE WHEN n <= 7 THEN p ELSE i END AS pick
    FROM placed JOIN picks ON CASE WHEN n <= 7 THEN p = i ELSE p = (i * n) // 7 END""")
def _(t):
    return strided_pick(t.shapes, ["shape_id"], "shape_pt_sequence", 7).select(
        "shape_id", "shape_pt_sequence", "pick"
    )


@query("evenly_spaced_segments", "SELECT * FROM g_even")
def _(t):
    placed = with_position(t.shapes, ["shape_id"], "shape_pt_sequence", size="group_size")
    return evenly_spaced_segments(placed, "shape_id")


# --- corridors -----------------------------------------------------------------------

CTES["g_counted"] = """
    SELECT route_id, route_short_name, route_long_name, route_type,
           COUNT(DISTINCT shape_id) AS shapes
    FROM g_bridge GROUP BY ALL"""


@query("select_routes", f"""
    WITH ranked AS (
        SELECT *, ROW_NUMBER() OVER (ORDER BY route_short_name IN ({PRIORITY}) DESC, shapes DESC,
                                     route_id) AS place
        FROM g_counted)
    SELECT route_id, route_short_name, shapes FROM ranked
    WHERE place <= 10 OR route_short_name IN ({PRIORITY})""")
def _(t):
    counted = t.trips.select("route_id", "shape_id").distinct().groupBy("route_id").agg(
        F.count("*").alias("shapes")
    )
    return select_routes(counted.join(t.routes, "route_id"), max_routes=10).select(
        "route_id", "route_short_name", "shapes"
    )


@query("corridors_from_shapes", f"""
    WITH joined AS (
        SELECT r.*, e.*, segment + 1 AS number, {KM} AS km
        FROM g_even e JOIN g_longest USING (shape_id) JOIN g_routes r USING (route_id)
        WHERE points >= 4 AND route_short_name IS NOT NULL)
    SELECT {CORRIDOR_COLUMNS}, {rounded("km", 2)} AS distance_km FROM joined WHERE km >= 0.3""")
def _(t):
    return flattened(corridors_from_shapes(t.feed_shapes, t.feed_trips, t.routes))


@query("corridors_from_waypoints", f"""
    WITH measured AS (SELECT *, {KM} AS km FROM g_route_segments
                      WHERE route_short_name IS NOT NULL),
    useful AS (
        SELECT *, ROW_NUMBER() OVER own - 1 AS p,
               COUNT(*) OVER (PARTITION BY route_short_name) AS n
        FROM measured WHERE km >= 0.5
        WINDOW own AS (PARTITION BY route_short_name ORDER BY shape_id, shape_pt_sequence)),
    picks AS (SELECT UNNEST([0, 1, 2]) AS i),
    joined AS (
        SELECT *, i + 1 AS number FROM useful
        JOIN picks ON CASE WHEN n <= 3 THEN p = i ELSE p = (i * n) // 3 END)
    SELECT {CORRIDOR_COLUMNS}, {rounded("km", 2)} AS distance_km FROM joined""")
def _(t):
    waypoints = t.route_segments.select(
        "origin_lat", "origin_lon", "dest_lat", "dest_lon", "shape_id", "shape_pt_sequence",
        F.col("route_short_name").alias("route_name"),
    )
    return flattened(
        corridors_from_waypoints(waypoints, t.routes, order="shape_pt_sequence")
    )


@query("corridors_by_type", f"""
    WITH joined AS (
        SELECT route_type, {KM} AS km
        FROM g_even JOIN g_longest USING (shape_id) JOIN g_routes USING (route_id)
        WHERE points >= 4 AND route_short_name IS NOT NULL)
    SELECT CASE route_type WHEN 0 THEN 'tram' WHEN 1 THEN 'subway' WHEN 2 THEN 'rail'
                WHEN 4 THEN 'ferry' ELSE 'bus' END AS corridor_type, COUNT(*) AS segments
    FROM joined WHERE km >= 0.3 GROUP BY 1""")
def _(t):
    return corridors_by_type(corridors_from_shapes(t.feed_shapes, t.feed_trips, t.routes))


@query("corridor_names", """
    SELECT p_partkey, 'route_' || p_brand || '_seg_' || p_size AS corridor_id,
           CASE WHEN p_size % 2 = 0 THEN p_brand || ' ' || p_name || ' (segment ' || p_size || ')'
                ELSE 'Route ' || p_brand || ' (segment ' || p_size || ')' END AS corridor_name,
           CASE WHEN p_type = 'bus' THEN 50 ELSE 80 END AS speed_limit_kmh
    FROM part""")
def _(t):
    long_name = F.when(F.col("p_size") % 2 == 0, F.col("p_name"))
    brand, number = F.col("p_brand"), F.col("p_size")
    return t.raw("part").select(
        "p_partkey", corridor_id(brand, number).alias("corridor_id"),
        corridor_name(brand, long_name, number).alias("corridor_name"),
        speed_limit(F.col("p_type")).alias("speed_limit_kmh"),
    )


ARTERIAL_ORIGINS = """
    (VALUES (49.3155, -123.1385, 'Lions Gate Bridge'), (49.2935, -123.0235, 'Ironworkers Memorial'),
            (49.1645, -122.9440, 'Alex Fraser Bridge'), (49.2095, -122.8165, 'Port Mann Bridge'),
            (49.2075, -122.8885, 'Pattullo Bridge'), (49.2640, -123.0100, 'Hwy 1 Burnaby'),
            (49.2580, -122.9400, 'Hwy 1 Coquitlam'), (49.2105, -123.1295, 'Oak Street Bridge'),
            (49.2015, -123.1560, 'Arthur Laing Bridge'), (49.1360, -123.0715, 'Massey Tunnel'),
            (49.2055, -123.0765, 'Knight St Bridge'), (49.2320, -123.0465, 'Kingsway Burnaby'),
            (49.2095, -123.1605, 'Marine Drive'), (49.2565, -122.8925, 'Lougheed Hwy'),
            (49.2425, -123.0050, 'Canada Way')) AS arterials(lat, lon, name)"""


@query("stops_near_arterials", f"""
    SELECT name, stop_id FROM {ARTERIAL_ORIGINS} JOIN g_stops
      ON ABS(stop_lat - lat) < 0.008 AND ABS(stop_lon - lon) < 0.012
    WHERE {flat("CAST(lat AS DOUBLE)", "CAST(lon AS DOUBLE)", "stop_lat", "stop_lon")} < 800""")
def _(t):
    origins = arterial_corridors(t.spark).select(
        "name", F.col("origin_lat").alias("lat"), F.col("origin_lon").alias("lon")
    )
    return stops_within(origins, t.stops).select("name", "stop_id")


# --- places --------------------------------------------------------------------------

@query("stops_within", f"""
    SELECT request_id, stop_id, {rounded("distance_m", 3)} AS distance_m
    FROM (SELECT request_id, stop_id,
                 {flat("origin_lat", "origin_lon", "stop_lat", "stop_lon")} AS distance_m
          FROM g_requests JOIN g_stops
            ON ABS(stop_lat - origin_lat) < 0.008 AND ABS(stop_lon - origin_lon) < 0.012)
    WHERE distance_m < 800""")
def _(t):
    return stops_within(t.requests, t.stops, lat="origin_lat", lon="origin_lon").select(
        "request_id", "stop_id", F.round("distance_m", 3).alias("distance_m")
    )


@query("nearest_stops_to", f"""
    SELECT stop_id, stop_name, {rounded("distance_m", 1)} AS distance_m
    FROM (SELECT *, {flat("49.2203e0", "-123.0117e0", "stop_lat", "stop_lon")} AS distance_m
          FROM g_stops)
    ORDER BY g_stops.distance_m, stop_id LIMIT 5""".replace("g_stops.distance_m", "distance_m"))
def _(t):
    return nearest_stops_to(t.stops, 49.2203, -123.0117).select(
        "stop_id", "stop_name", "distance_m"
    )


@query("nearest_stops", f"""
    WITH ranked AS (
        SELECT request_id, stop_id, distance,
               ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY distance, stop_id) AS rank
        FROM (SELECT request_id, stop_id,
                     {flat("origin_lat", "origin_lon", "stop_lat", "stop_lon")} AS distance
              FROM g_requests CROSS JOIN g_stops))
    SELECT request_id, CAST(rank AS INTEGER) AS rank, stop_id,
           {rounded("distance", 1)} AS distance_m
    FROM ranked WHERE rank <= 5""")
def _(t):
    return nearest_stops(
        t.requests, t.stops, key="request_id", lat="origin_lat", lon="origin_lon"
    ).select("request_id", "rank", "stop_id", "distance_m")


# --- live congestion -----------------------------------------------------------------

@query("segments_near_cells", """
    SELECT lat, lon, shape_id, shape_pt_sequence, route_id FROM g_near""")
def _(t):
    cells = slow_cells(t.grid).select("lat", "lon", "level", "avg_speed")
    order = ["shape_id", "shape_pt_sequence", "route_id"]
    return segments_near_cells(cells, t.route_segments, order).select(
        "lat", "lon", *order
    )


@query("segments_near_all_cells", """
    SELECT c.lat, c.lon, COUNT(*) AS segments
    FROM g_grid c JOIN g_route_segments s
      ON ABS(s.origin_lat - c.lat) < 0.006e0 AND ABS(s.origin_lon - c.lon) < 0.006e0
    GROUP BY 1, 2""")
def _(t):
    near = segments_near_cells(t.grid.select("lat", "lon"), t.route_segments, [])
    return near.groupBy("lat", "lon").agg(F.count("*").alias("segments"))


DEDUPE_KEYS = ", ".join(
    half_even(c, 4) for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon")
)


@query("dedupe_segments", f"""
    SELECT shape_id, shape_pt_sequence FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY {DEDUPE_KEYS}
                                     ORDER BY shape_id, shape_pt_sequence, route_id) AS place
        FROM g_route_segments) WHERE place = 1""")
def _(t):
    return dedupe_segments(
        t.route_segments, ["shape_id", "shape_pt_sequence", "route_id"]
    ).select("shape_id", "shape_pt_sequence")


@query("slow_corridor_targets", f"""
    WITH once AS (
        SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (
                       PARTITION BY {DEDUPE_KEYS}
                       ORDER BY lat, lon, shape_id, shape_pt_sequence, route_id) AS place
            FROM g_near) WHERE place = 1)
    SELECT origin_lat, origin_lon, dest_lat, dest_lon, route_short_name AS route_name,
           level AS trigger, avg_speed AS bus_speed
    FROM once""")
def _(t):
    return slow_corridor_targets(t.grid, t.route_segments)


@query("traffic_level", """
    SELECT event_id, CASE
        WHEN jammed / 3.0 > 0.3 THEN 'HIGH' WHEN slow / 3.0 > 0.3 THEN 'MEDIUM' ELSE 'LOW' END
        AS level
    FROM (SELECT event_id,
                 CASE WHEN event_type = 'view' THEN 0 ELSE (CASE WHEN event_type = 'click' THEN 1
                      ELSE 0 END) + (CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) END AS jammed,
                 CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE 1 END AS slow
          FROM events)""")
def _(t):
    route = F.get(parsed_response(F.col("api_response_json"))["routes"], 0)
    intervals = F.coalesce(route["travelAdvisory"]["speedReadingIntervals"], F.array())
    return t.responses.select("event_id", traffic_level(intervals).alias("level"))


CTES["g_traffic_segments"] = """
    WITH known AS (SELECT * FROM (VALUES (0, 38.5e0, -120.2e0), (1, 40.7e0, -120.95e0),
                                         (2, 43.252e0, -126.453e0)) AS p(i, lat, lon)),
    -- Three points, none, two, and a text that is no polyline.
    points AS (SELECT kind, known.* FROM known, (VALUES (0, 3), (2, 2)) AS k(kind, size) WHERE i < size),
    routes AS (
        SELECT *, api_response_json -> '$.routes[0]' AS route FROM g_responses),
    listed AS (
        SELECT event_id, origin_lat, origin_lon, dest_lat, dest_lon,
               TRY_CAST(rtrim(route ->> '$.duration', 's') AS INTEGER) AS duration,
               CAST(route ->> '$.distanceMeters' AS INTEGER) AS distance,
               CAST(route -> '$.travelAdvisory.speedReadingIntervals' AS JSON[]) AS readings
        FROM routes),
    spread AS (
        SELECT event_id, duration, distance, UNNEST(readings) AS reading,
               generate_subscripts(readings, 1) - 1 AS interval,
               len(list_filter(readings, lambda r: (r ->> 'speed') = 'TRAFFIC_JAM')) / 3.0 AS jam,
               len(list_filter(readings, lambda r: (r ->> 'speed') = 'SLOW')) / 3.0 AS slow
        FROM listed WHERE readings IS NOT NULL),
    bounds AS (
        SELECT *, COALESCE(CAST(reading ->> 'startPolylinePointIndex' AS INTEGER), 0) AS si,
               CAST(reading ->> 'endPolylinePointIndex' AS INTEGER) AS ei
        FROM spread)
    SELECT event_id, duration, distance, CAST(interval AS INTEGER) AS interval,
           a.lat AS start_lat, a.lon AS start_lon,
           COALESCE(b.lat, a.lat) AS end_lat, COALESCE(b.lon, a.lon) AS end_lon,
           CASE WHEN jam > 0.3 THEN 'HIGH' WHEN slow > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS level,
           COALESCE(reading ->> 'speed', 'NORMAL') AS speed, 1 AS samples
    FROM bounds LEFT JOIN points a ON a.i = si AND a.kind = event_id % 4
    LEFT JOIN points b ON b.i = COALESCE(ei, si + 1) AND b.kind = event_id % 4
    UNION ALL
    SELECT event_id, duration, distance, 0, origin_lat, origin_lon, dest_lat, dest_lon, 'LOW',
           'UNKNOWN', 1
    FROM listed WHERE readings IS NULL"""


@query("traffic_segments", "SELECT * FROM g_traffic_segments")
def _(t):
    return traffic_segments(t.responses)


@query("traffic_level_counts", """
    SELECT level, COUNT(*) AS segments FROM g_traffic_segments GROUP BY level""")
def _(t):
    return level_counts(traffic_segments(t.responses))


def layers(t):
    painted = paint_routes(route_speeds(t.speeds), t.shapes, t.shape_labels)
    answers = traffic_segments(t.responses)
    return {
        "bus_route": painted.select("route", "level", "start_lat", "start_lon", "source"),
        "google_arterial": answers.filter("level = 'HIGH'").select(
            "level", "start_lat", "start_lon"
        ),
        "google_targeted": answers.filter("level = 'MEDIUM'").select(
            "level", "start_lat", "start_lon"
        ),
        "google": answers.filter("level = 'LOW'").select("level", "start_lat", "start_lon"),
    }


@query("combine_congestion", """
    SELECT route, level, start_lat, start_lon, source FROM g_painted
    UNION ALL
    SELECT NULL, level, start_lat, start_lon,
           CASE level WHEN 'HIGH' THEN 'google_arterial' WHEN 'MEDIUM' THEN 'google_targeted'
                      ELSE 'google' END
    FROM g_traffic_segments""")
def _(t):
    return combine_congestion(layers(t))


@query("live_congestion", """
    SELECT route, level, start_lat, start_lon, source FROM g_painted WHERE route = '003'""")
def _(t):
    return live_congestion(layers(t), "003")


# Look-ups answered for hours, quarter hours and routes, one segment per event.
CTES["g_answers"] = """
    SELECT HOUR(ts) || '_' || user_id % 7 + 1 || suffix AS cache_key, event_id
    FROM events, (VALUES (0), (1), (2)) AS kinds(kind),
         LATERAL (SELECT CASE kind WHEN 0 THEN '' WHEN 1 THEN '_q' || MINUTE(ts) // 15 * 15
                         ELSE '_r_r' || event_id % 5 END AS suffix)"""


def answers(t):
    events = t.raw("events")
    hour, day = F.hour("ts"), (F.col("user_id") % 7 + 1).cast("int")
    quarter = F.concat(F.lit("_q"), (F.floor(F.minute("ts") / 15) * 15).cast("string"))
    keys = F.array(
        hour_key(hour, day), F.concat(hour_key(hour, day), quarter),
        route_key(hour, day, F.concat(F.lit("R"), (F.col("event_id") % 5).cast("string"))),
    )
    return events.select(F.explode(keys).alias("cache_key"), "event_id")


NOW = "TIMESTAMP '2024-01-15 08:20:00'"


def at_that_time(t, **asked):
    painted = t.raw("events").select(
        "event_id", F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("route")
    )
    arterial = t.raw("events").select("event_id", F.col("ts").alias("queried_at"))
    found = congestion_at(painted, arterial, answers(t), now=F.expr(NOW), hour=8, day=2, **asked)
    return found.select("event_id", "source")


LIVE = f"""
    SELECT event_id, 'bus_route' AS source FROM events {{0}}"""
CACHED = """
    SELECT event_id, 'google_targeted' AS source FROM g_answers WHERE cache_key = '8_2_q15'
    UNION ALL SELECT event_id, 'google' FROM g_answers WHERE cache_key = '8_2'"""


@query("congestion_now", f"""
    {LIVE.format("")} UNION ALL {CACHED} UNION ALL
    SELECT event_id, 'google_arterial' FROM events WHERE ts > {NOW} - INTERVAL 15 MINUTES""")
def _(t):
    return at_that_time(t, live=True)


@query("congestion_explored", CACHED)
def _(t):
    return at_that_time(t)


@query("congestion_of_route", """
    SELECT event_id, 'google_route' AS source FROM g_answers WHERE cache_key = '8_2_r_r3'""")
def _(t):
    return at_that_time(t, route="R3")


@query("congestion_of_route_now", LIVE.format("WHERE user_id % 5 = 3"))
def _(t):
    return at_that_time(t, route="r3", live=True)
