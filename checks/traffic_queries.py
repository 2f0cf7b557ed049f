"""Queries over traffic readings, delays and predictions, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.query import CTES, case_chain, percentile, query, rounded
from checks.schedule_queries import TYPE_NAME
from headway.functions.labels import congestion_severity, route_from_corridor
from headway.functions.responses import parse_duration
from headway.functions.times import hour_key, quarter_key, route_key
from headway.operators.delays import (
    join_schedule_with_actual,
    route_delay_patterns,
    route_scheduled,
    worst_delays,
)
from headway.operators.latest import dedupe_latest, missing_keys
from headway.operators.quality import drop_failed_polls
from headway.operators.scd import append_existing, expire, upsert_by_key
from headway.operators.traffic import (
    congestion_patterns,
    corridor_daily,
    corridor_to_route,
    current_delay,
    most_congested_now,
    parse_route_response,
    route_performance_metrics,
    traffic_congestion_metrics,
    with_time_dimensions,
)
from headway.plans.live import peak_keys_to_fill, quarter_hour_readings
from headway.plans.predict import day_profile, predict_travel_time, seasonal_factors
from headway.plans.traffic import corridor_daily_summary, delay_patterns
from headway.streaming.gold import daily_from_parts, merge_parts, reading_parts

SEVERITY = case_chain(
    "congestion_ratio",
    [("< 1.1", "free_flow"), ("< 1.3", "light"), ("< 1.6", "moderate"), ("< 2.0", "heavy")],
    "severe",
)
PERIOD = case_chain(
    "EXTRACT(hour FROM polled_at)",
    [
        ("BETWEEN 7 AND 9", "morning_rush"), ("BETWEEN 10 AND 15", "midday"),
        ("BETWEEN 16 AND 18", "evening_rush"), ("BETWEEN 19 AND 21", "evening"),
    ],
    "overnight",
)
TIME_COLUMNS = f"""CAST(EXTRACT(hour FROM polled_at) AS INTEGER) AS hour_of_day,
           CAST(EXTRACT(dow FROM polled_at) + 1 AS INTEGER) AS day_of_week,
           CAST(polled_at AS DATE) AS poll_date, {PERIOD} AS time_period,
           CASE WHEN EXTRACT(dow FROM polled_at) IN (0, 6) THEN 'weekend' ELSE 'weekday' END
               AS day_type"""
CORRIDOR_ROUTE = r"regexp_extract(corridor_id, 'route_(.+)_seg_\d+', 1)"

CTES["g_answered"] = """
    SELECT * FROM g_traffic WHERE api_response_json NOT LIKE '%"error"%'
    AND corridor_id IS NOT NULL AND polled_at IS NOT NULL"""
CTES["g_once"] = """
    SELECT * EXCLUDE (place)
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY corridor_id, polled_at
                     ORDER BY _file_arrival_time DESC, event_id DESC) AS place
          FROM g_answered)
    WHERE place = 1"""
CTES["g_readings"] = f"""
    SELECT corridor_id, corridor_name, polled_at, event_id, static_duration_seconds,
           duration_seconds, congestion_ratio, distance_meters,
           {SEVERITY} AS congestion_severity, {TIME_COLUMNS}
    FROM g_once"""
CTES["g_plan"] = f"""
    SELECT route_id, route_name, route_type, departure_hour, COUNT(*) AS scheduled_segments,
           {rounded("AVG(scheduled_segment_seconds)", 0)} AS avg_scheduled_seconds,
           {rounded(percentile("scheduled_segment_seconds", 0.5), 0)}
               AS median_scheduled_seconds
    FROM g_segments
    WHERE scheduled_segment_seconds > 0 AND scheduled_segment_seconds < 7200
    GROUP BY ALL"""
CTES["g_comparison"] = f"""
    SELECT route_id, route_name, route_type, corridor_name AS segment_name, hour_of_day, day_type,
           poll_date AS report_date, avg_scheduled_seconds AS scheduled_seconds,
           scheduled_segments, duration_seconds AS actual_seconds,
           static_duration_seconds AS free_flow_seconds, congestion_ratio, congestion_severity,
           duration_seconds - avg_scheduled_seconds AS delay_seconds,
           {rounded("(duration_seconds - avg_scheduled_seconds) / "
                    "NULLIF(avg_scheduled_seconds, 0) * 100", 1)} AS delay_pct
    FROM g_readings JOIN g_plan
      ON {CORRIDOR_ROUTE} = route_name AND departure_hour = hour_of_day
    WHERE corridor_id LIKE 'route\\_%' ESCAPE '\\' AND duration_seconds IS NOT NULL"""
CTES["g_delays"] = f"""
    WITH votes AS (
        SELECT route_id, route_name, route_type, hour_of_day, day_type, congestion_severity,
               ROW_NUMBER() OVER (PARTITION BY route_id, route_name, route_type, hour_of_day,
                                  day_type ORDER BY COUNT(*) DESC, congestion_severity) AS place
        FROM g_comparison
        GROUP BY route_id, route_name, route_type, hour_of_day, day_type, congestion_severity),
    figures AS (
        SELECT route_id, route_name, route_type, hour_of_day, day_type, COUNT(*) AS sample_size,
               {rounded("AVG(delay_seconds)", 0)} AS avg_delay_seconds,
               {rounded(percentile("delay_seconds", 0.5), 0)} AS median_delay_seconds,
               {rounded(percentile("delay_seconds", 0.95), 0)} AS p95_delay_seconds,
               {rounded("MAX(delay_seconds)", 0)} AS max_delay_seconds,
               {rounded("COUNT(*) FILTER (delay_seconds > 60) * 100.0e0 / COUNT(*)", 1)}
                   AS pct_delayed,
               {rounded("COUNT(*) FILTER (ABS(delay_seconds) <= 120) * 100.0e0 / COUNT(*)", 1)}
                   AS pct_on_time,
               {rounded("AVG(congestion_ratio)", 3)} AS avg_congestion_ratio
        FROM g_comparison GROUP BY route_id, route_name, route_type, hour_of_day, day_type
        HAVING COUNT(*) >= 3)
    SELECT figures.*, congestion_severity AS typical_severity
    FROM figures JOIN votes USING (route_id, route_name, route_type, hour_of_day, day_type)
    WHERE place = 1"""
CTES["g_daily"] = f"""
    SELECT corridor_id, corridor_name, poll_date, day_type, COUNT(*) AS num_readings,
           {rounded("AVG(congestion_ratio)", 3)} AS avg_congestion_ratio,
           {rounded("MAX(congestion_ratio)", 3)} AS peak_congestion_ratio,
           {rounded("AVG(duration_seconds)", 0)} AS avg_duration_seconds,
           {rounded("AVG(static_duration_seconds)", 0)} AS avg_static_duration_seconds,
           {rounded("AVG(distance_meters)", 0)} AS avg_distance_meters
    FROM g_readings GROUP BY corridor_id, corridor_name, poll_date, day_type"""
CTES["g_profiles"] = """
    SELECT corridor_id, corridor_name, day_of_week, hour_of_day AS hour,
           AVG(congestion_ratio) AS avg_congestion_ratio,
           AVG(duration_seconds) AS avg_duration_seconds,
           AVG(static_duration_seconds) AS avg_static_duration_seconds,
           STDDEV(congestion_ratio) AS stddev_congestion_ratio, COUNT(*) AS sample_count
    FROM g_readings GROUP BY corridor_id, corridor_name, day_of_week, hour_of_day"""
CTES["g_monthly"] = """
    SELECT corridor_id, EXTRACT(month FROM polled_at) AS month, AVG(congestion_ratio) AS ratio
    FROM g_readings GROUP BY 1, 2"""
CTES["g_factors"] = """
    SELECT m.corridor_id, m.ratio / a.ratio AS seasonal_multiplier
    FROM g_monthly m JOIN (SELECT corridor_id, AVG(ratio) AS ratio FROM g_monthly GROUP BY 1) a
      ON a.corridor_id = m.corridor_id
    WHERE month = 1"""


def six(*columns: str):
    """Averages of doubles depend on summation order in the last bits; 6 digits do not."""
    return {c: F.round(c, 6) for c in columns}


# --- readings ------------------------------------------------------------------------

@query("drop_failed_polls", "SELECT corridor_id, event_id FROM g_answered")
def _(t):
    return drop_failed_polls(t.traffic).select("corridor_id", "event_id")


@query("dedupe_latest", "SELECT corridor_id, polled_at, event_id FROM g_once")
def _(t):
    return dedupe_latest(
        drop_failed_polls(t.traffic), newest=["_file_arrival_time", "event_id"]
    ).select("corridor_id", "polled_at", "event_id")


@query("congestion_severity", f"SELECT event_id, {SEVERITY} AS severity FROM g_traffic")
def _(t):
    return t.traffic.select(
        "event_id", congestion_severity(F.col("congestion_ratio")).alias("severity")
    )


@query("time_dimensions", f"SELECT event_id, {TIME_COLUMNS} FROM g_traffic")
def _(t):
    return with_time_dimensions(t.traffic.select("event_id", "polled_at")).drop("polled_at")


@query("traffic_readings", "SELECT * FROM g_readings")
def _(t):
    return t.readings


@query("congestion_patterns", f"""
    SELECT corridor_id, corridor_name, day_of_week, day_type, hour_of_day, time_period,
           COUNT(*) AS num_observations,
           {rounded("AVG(congestion_ratio)", 3)} AS avg_congestion_ratio,
           {rounded(percentile("congestion_ratio", 0.5), 3)} AS median_congestion_ratio,
           {rounded(percentile("congestion_ratio", 0.95), 3)} AS p95_congestion_ratio,
           {rounded("AVG(duration_seconds)", 0)} AS avg_duration_seconds,
           {rounded("AVG(distance_meters)", 0)} AS avg_distance_meters,
           COUNT(*) FILTER (congestion_severity = 'free_flow') AS free_flow_count,
           COUNT(*) FILTER (congestion_severity = 'light') AS light_count,
           COUNT(*) FILTER (congestion_severity = 'moderate') AS moderate_count,
           COUNT(*) FILTER (congestion_severity = 'heavy') AS heavy_count,
           COUNT(*) FILTER (congestion_severity = 'severe') AS severe_count
    FROM g_readings
    GROUP BY corridor_id, corridor_name, day_of_week, day_type, hour_of_day, time_period""")
def _(t):
    return congestion_patterns(t.readings)


@query("corridor_daily", "SELECT * FROM g_daily")
def _(t):
    return corridor_daily(t.readings)


@query("corridor_daily_from_parts", "SELECT * FROM g_daily")
def _(t):
    """Parts of even and odd polls, added up as a refresh adds up batches."""
    parts = [reading_parts(t.readings.filter(F.col("event_id") % 2 == n)) for n in (0, 1)]
    return daily_from_parts(merge_parts(parts[0].unionByName(parts[1])))


@query("corridor_to_route", f"""
    SELECT corridor_id, route_id, r.route_short_name AS route_name, route_long_name,
           {TYPE_NAME.format("route_type")} AS route_type
    FROM (SELECT DISTINCT corridor_id FROM g_traffic) c
    LEFT JOIN g_routes r ON r.route_short_name = {CORRIDOR_ROUTE}""")
def _(t):
    return corridor_to_route(t.traffic.select("corridor_id").distinct(), t.routes)


@query("corridor_daily_summary", f"""
    SELECT corridor_id, corridor_name, poll_date AS report_date, day_type, route_id,
           r.route_short_name AS route_name, route_long_name,
           {TYPE_NAME.format("route_type")} AS route_type, num_readings, avg_congestion_ratio,
           peak_congestion_ratio, avg_duration_seconds, avg_static_duration_seconds,
           avg_distance_meters
    FROM g_daily LEFT JOIN g_routes r ON r.route_short_name = {CORRIDOR_ROUTE}""")
def _(t):
    return corridor_daily_summary(t.readings, t.routes)


@query("current_delay", """
    SELECT event_id, duration_seconds - static_duration_seconds AS delay_seconds
    FROM g_readings""")
def _(t):
    return current_delay(t.readings).select("event_id", "delay_seconds")


@query("most_congested_now", f"""
    SELECT corridor_id, polled_at, {rounded("congestion_ratio", 9)} AS congestion_ratio
    FROM g_readings ORDER BY g_readings.congestion_ratio DESC, corridor_id, polled_at LIMIT 20""")
def _(t):
    return most_congested_now(t.readings, 20).select(
        "corridor_id", "polled_at", F.round("congestion_ratio", 9).alias("congestion_ratio")
    )


@query("traffic_congestion_metrics", """
    SELECT corridor_id, corridor_name AS "Corridor Name", hour_of_day AS "Hour of Day",
           day_type AS "Day Type", time_period AS "Time Period",
           congestion_severity AS "Congestion Severity", poll_date AS "Report Date",
           congestion_ratio AS "Congestion Ratio", duration_seconds AS "Travel Time (seconds)",
           static_duration_seconds AS "Free Flow Time (seconds)",
           distance_meters AS "Distance (meters)"
    FROM g_readings""")
def _(t):
    return traffic_congestion_metrics(t.readings)


@query("parse_route_response", f"""
    WITH figures AS (
        SELECT event_id,
               TRY_CAST(rtrim(api_response_json ->> '$.routes[0].duration', 's') AS INTEGER)
                   AS duration_seconds,
               TRY_CAST(rtrim(api_response_json ->> '$.routes[0].staticDuration', 's') AS INTEGER)
                   AS static_duration_seconds,
               CAST(api_response_json ->> '$.routes[0].distanceMeters' AS INTEGER)
                   AS distance_meters
        FROM g_responses)
    SELECT *, CASE WHEN duration_seconds <> 0 AND static_duration_seconds > 0 THEN
               {rounded("duration_seconds / static_duration_seconds", 4)} END AS congestion_ratio
    FROM figures""")
def _(t):
    return parse_route_response(t.responses.select("event_id", "api_response_json")).drop(
        "api_response_json"
    )


@query("parse_duration", """
    SELECT event_id, CAST(event_id % 900 AS INTEGER) AS seconds FROM events""")
def _(t):
    text = F.concat((F.col("event_id") % 900).cast("string"), F.lit("s"))
    return t.raw("events").select("event_id", parse_duration(text).alias("seconds"))


@query("route_from_corridor", f"""
    SELECT event_id, {CORRIDOR_ROUTE} AS route_name, regexp_extract(
           'x' || CAST(event_id AS VARCHAR), 'route_(.+)_seg_\\d+', 1) AS no_match
    FROM g_traffic""")
def _(t):
    return t.traffic.select(
        "event_id", route_from_corridor(F.col("corridor_id")).alias("route_name"),
        route_from_corridor(F.concat(F.lit("x"), F.col("event_id").cast("string"))).alias(
            "no_match"
        ),
    )


@query("cache_keys", """
    SELECT event_id,
           EXTRACT(hour FROM ts) || '_' || (EXTRACT(dow FROM ts) + 1) || '_q'
               || CAST(FLOOR(EXTRACT(minute FROM ts) / 15) * 15 AS INTEGER) AS quarter,
           EXTRACT(hour FROM ts) || '_' || (EXTRACT(dow FROM ts) + 1) AS hourly,
           EXTRACT(hour FROM ts) || '_' || (EXTRACT(dow FROM ts) + 1) || '_r_'
               || LOWER(event_type) AS of_route
    FROM events""")
def _(t):
    ts = F.col("ts")
    hour, day = F.hour(ts), F.dayofweek(ts)
    return t.raw("events").select(
        "event_id", quarter_key(ts).alias("quarter"), hour_key(hour, day).alias("hourly"),
        route_key(hour, day, F.col("event_type")).alias("of_route"),
    )


@query("local_hour", """
    SELECT event_id,
           CAST(EXTRACT(hour FROM (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Vancouver')
                AS INTEGER) AS hour,
           CAST(EXTRACT(dow FROM (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Vancouver') + 1
                AS INTEGER) AS day
    FROM events""")
def _(t):
    local = with_time_dimensions(t.raw("events"), "ts", "America/Vancouver")
    return local.select(
        "event_id", F.col("hour_of_day").alias("hour"), F.col("day_of_week").alias("day")
    )


@query("quarter_hour_readings", f"""
    SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS bucket_start,
           EXTRACT(hour FROM time_bucket(INTERVAL 15 MINUTES, ts)) || '_'
               || (EXTRACT(dow FROM time_bucket(INTERVAL 15 MINUTES, ts)) + 1) || '_q'
               || EXTRACT(minute FROM time_bucket(INTERVAL 15 MINUTES, ts)) AS cache_key,
           COUNT(*) AS readings, {rounded("AVG(value)", 6)} AS avg_congestion_ratio
    FROM events GROUP BY time_bucket(INTERVAL 15 MINUTES, ts)""")
def _(t):
    readings = t.raw("events").withColumnRenamed("value", "congestion_ratio")
    return quarter_hour_readings(readings, "ts").withColumns(six("avg_congestion_ratio"))


# --- schedule against actual ---------------------------------------------------------

@query("route_scheduled", "SELECT * FROM g_plan")
def _(t):
    return route_scheduled(t.segments)


@query("schedule_with_actual_wrapped", f"""
    SELECT route_id, event_id, scheduled_segments
    FROM (SELECT *, 'route_' || {CORRIDOR_ROUTE} AS keyed FROM g_readings) JOIN g_plan
      ON keyed = 'route_' || route_name AND departure_hour % 24 = hour_of_day""")
def _(t):
    readings = t.readings.withColumn("corridor_name", F.col("event_id"))
    return join_schedule_with_actual(
        route_scheduled(t.segments), readings, wrap_hours=True
    ).select("route_id", F.col("segment_name").alias("event_id"), "scheduled_segments")


@query("schedule_vs_actual", "SELECT * FROM g_comparison")
def _(t):
    return t.comparison


@query("route_delay_patterns", "SELECT * FROM g_delays")
def _(t):
    return delay_patterns(t.segments, t.readings)


@query("route_performance_metrics", """
    SELECT route_id, route_name AS "Route Name", route_type AS "Route Type",
           hour_of_day AS "Hour of Day", day_type AS "Day Type",
           avg_delay_seconds AS "Avg Delay (seconds)",
           median_delay_seconds AS "Median Delay (seconds)",
           p95_delay_seconds AS "P95 Delay (seconds)", pct_delayed AS "% Delayed",
           pct_on_time AS "% On Time", avg_congestion_ratio AS "Avg Congestion Ratio",
           typical_severity AS "Typical Severity", sample_size AS "Sample Size"
    FROM g_delays""")
def _(t):
    return route_performance_metrics(route_delay_patterns(t.comparison))


@query("worst_delays", """
    SELECT route_name, hour_of_day, day_type, avg_delay_seconds, pct_on_time, avg_congestion_ratio
    FROM g_delays ORDER BY avg_delay_seconds DESC, route_id, hour_of_day, day_type LIMIT 10""")
def _(t):
    return worst_delays(route_delay_patterns(t.comparison)).select(
        "route_name", "hour_of_day", "day_type", "avg_delay_seconds", "pct_on_time",
        "avg_congestion_ratio",
    )


# --- caches --------------------------------------------------------------------------

CTES["g_cache_old"] = "SELECT * FROM g_cache WHERE hour_of_day < 12"
CTES["g_cache_new"] = "SELECT * FROM g_cache WHERE hour_of_day >= 8"
# A batch whose rows were touched an hour before or after those that are kept.
CTES["g_cache_batch"] = """
    SELECT * REPLACE (last_accessed_at + INTERVAL 1 HOUR * (event_id % 2 * 2 - 1) AS last_accessed_at,
                      segments_json || ' ' AS segments_json) FROM g_cache_new"""


@query("upsert_by_key", """
    WITH both_sides AS (SELECT *, 0 AS fresh FROM g_cache_old
                        UNION ALL SELECT *, 1 AS fresh FROM g_cache_batch)
    SELECT cache_key, hour_of_day, day_of_week, segments_json, event_id
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cache_key
                 ORDER BY last_accessed_at DESC, fresh DESC) AS place FROM both_sides)
    WHERE place = 1""")
def _(t):
    old = t.cache.filter("hour_of_day < 12")
    hours = F.make_dt_interval(hours=(F.col("event_id") % 2 * 2 - 1).cast("int"))
    new = t.cache.filter("hour_of_day >= 8").withColumns(
        {"last_accessed_at": F.col("last_accessed_at") + hours, "segments_json": F.concat("segments_json", F.lit(" "))}
    )
    return upsert_by_key(old, new, ["cache_key"], "last_accessed_at").drop("last_accessed_at")


@query("expire", """
    SELECT cache_key, event_id FROM g_cache
    WHERE last_accessed_at >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 24 HOURS""")
def _(t):
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return expire(t.cache, "last_accessed_at", now).select("cache_key", "event_id")


@query("append_existing", """
    SELECT event_id FROM g_cache_old UNION ALL SELECT event_id FROM g_cache_new""")
def _(t):
    old, new = t.cache.filter("hour_of_day < 12"), t.cache.filter("hour_of_day >= 8")
    return append_existing(old.select("event_id"), new.select("event_id"))


@query("missing_keys", """
    SELECT DISTINCT hour || '_' || request_id % 9 AS cache_key FROM g_requests
    WHERE hour || '_' || request_id % 9 NOT IN (SELECT cache_key FROM g_cache)""")
def _(t):
    key = F.concat_ws("_", "hour", F.col("request_id") % 9).alias("cache_key")
    return missing_keys(t.requests.select(key).distinct(), t.cache, ["cache_key"])


@query("peak_keys_to_fill", """
    WITH ahead AS (
        SELECT DISTINCT CAST((EXTRACT(hour FROM ts) + offset_hours) % 24 AS INTEGER) AS hour,
               CAST(EXTRACT(dow FROM ts) + 1 AS INTEGER) AS day
        FROM events, (SELECT UNNEST([1, 2]) AS offset_hours))
    SELECT hour || '_' || day AS cache_key, hour, day FROM ahead
    WHERE (hour BETWEEN 6 AND 10 OR hour BETWEEN 15 AND 19)
      AND hour || '_' || day NOT IN (SELECT hour || '_' || request_id % 5 FROM g_requests)""")
def _(t):
    moments = t.raw("events").select(F.col("ts").alias("now"))
    have = t.requests.select(F.concat_ws("_", "hour", F.col("request_id") % 5).alias("cache_key"))
    return peak_keys_to_fill(moments, have)


@query("cache_stats", """
    SELECT COUNT(*) AS entries, MIN(last_accessed_at) AS oldest, MAX(last_accessed_at) AS newest
    FROM g_cache""")
def _(t):
    return t.cache.agg(
        F.count("*").alias("entries"), F.min("last_accessed_at").alias("oldest"),
        F.max("last_accessed_at").alias("newest"),
    )


# --- prediction ----------------------------------------------------------------------

MEASURES = (
    "avg_congestion_ratio", "avg_duration_seconds", "avg_static_duration_seconds",
    "stddev_congestion_ratio",
)


@query("hourly_profiles", f"""
    SELECT corridor_id, corridor_name, day_of_week, hour, sample_count,
           {", ".join(f"{rounded(m, 6)} AS {m}" for m in MEASURES)}
    FROM g_profiles""")
def _(t):
    return t.profiles.withColumns(six(*MEASURES))


@query("seasonal_factors", f"""
    SELECT corridor_id, {rounded("seasonal_multiplier", 6)} AS seasonal_multiplier
    FROM g_factors""")
def _(t):
    return seasonal_factors(t.readings, 1).withColumns(six("seasonal_multiplier"))


PREDICTED = (
    "free_flow_seconds", "predicted_seconds", "low_seconds", "high_seconds", "congestion_ratio",
)


@query("predict_travel_time", f"""
    WITH asked AS (
        SELECT corridor_id, CAST(day AS INTEGER) AS day_of_week, CAST(hour AS INTEGER) AS hour
        FROM (SELECT DISTINCT corridor_id FROM g_traffic), (SELECT UNNEST(range(1, 8)) AS day),
             (SELECT UNNEST(range(24)) AS hour)),
    base AS (
        SELECT corridor_id, day_of_week, hour, avg_static_duration_seconds AS free_flow_seconds,
               COALESCE(seasonal_multiplier, 1.1) AS season, avg_duration_seconds,
               avg_congestion_ratio, COALESCE(stddev_congestion_ratio, 0) AS spread,
               COALESCE(sample_count, 0) AS sample_count,
               CASE WHEN sample_count IS NULL THEN 'none' ELSE 'direct' END AS data_source
        FROM asked LEFT JOIN g_profiles USING (corridor_id, day_of_week, hour)
        LEFT JOIN g_factors USING (corridor_id)),
    figures AS (
        SELECT *, avg_duration_seconds * season AS predicted_seconds,
               GREATEST(avg_duration_seconds * season - spread * free_flow_seconds,
                        free_flow_seconds) AS low_seconds,
               avg_duration_seconds * season + spread * free_flow_seconds AS high_seconds,
               avg_congestion_ratio * season AS congestion_ratio
        FROM base)
    SELECT corridor_id, day_of_week, hour, sample_count, data_source,
           {", ".join(f"{rounded(m, 6)} AS {m}" for m in PREDICTED)}
    FROM figures""")
def _(t):
    requests = t.traffic.select("corridor_id").distinct().select(
        "corridor_id", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("day_of_week")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return (
        predict_travel_time(requests, t.profiles, seasonal_factors(t.readings, 1))
        .withColumns(six(*PREDICTED))
        .drop("used_corridor_id", "scale_factor", "seasonal_multiplier")
    )


@query("predict_with_proxy", f"""
    WITH asked AS (SELECT 'planned_' || corridor_id AS corridor_id, corridor_id AS used,
                          day_of_week, hour FROM g_profiles)
    SELECT asked.corridor_id, used AS used_corridor_id, day_of_week, hour,
           {rounded("avg_duration_seconds * (13.0e0 / 7.2e0) * COALESCE(seasonal_multiplier, 1.1)", 6)}
               AS predicted_seconds,
           {rounded("avg_static_duration_seconds * (13.0e0 / 7.2e0)", 6)} AS free_flow_seconds
    FROM asked JOIN g_profiles p USING (day_of_week, hour)
    LEFT JOIN g_factors f ON f.corridor_id = used
    WHERE p.corridor_id = used""")
def _(t):
    requests = t.profiles.select(
        F.concat(F.lit("planned_"), "corridor_id").alias("corridor_id"), "day_of_week", "hour"
    )
    proxies = t.traffic.select("corridor_id").distinct().select(
        F.concat(F.lit("planned_"), "corridor_id").alias("corridor_id"),
        F.col("corridor_id").alias("proxy_corridor_id"),
        F.lit(13.0 / 7.2).alias("scale_factor"),
    )
    predicted = predict_travel_time(
        requests, t.profiles, seasonal_factors(t.readings, 1), proxies=proxies
    )
    return predicted.select(
        "corridor_id", "used_corridor_id", "day_of_week", "hour",
        F.round("predicted_seconds", 6).alias("predicted_seconds"),
        F.round("free_flow_seconds", 6).alias("free_flow_seconds"),
    )


@query("day_profile", f"""
    SELECT hour, CAST(avg_static_duration_seconds / 60 AS FLOAT) AS freeflow_minutes,
           CAST(avg_duration_seconds * COALESCE(seasonal_multiplier, 1.1) / 60 AS FLOAT)
               AS predicted_minutes,
           {rounded("avg_congestion_ratio", 6)} AS avg_congestion_ratio, sample_count
    FROM g_profiles LEFT JOIN g_factors USING (corridor_id)
    WHERE corridor_id = 'route_007_seg_1' AND day_of_week = 2""")
def _(t):
    return day_profile(
        t.profiles, seasonal_factors(t.readings, 1), "route_007_seg_1", 2
    ).withColumns(six("avg_congestion_ratio"))
