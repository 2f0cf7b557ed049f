"""Travel-time prediction from hourly and seasonal profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.times import day_of_week, hour_of_day, local_time

# Month of the seasonal factor and the factor without data.
SEASON_MONTH = 9
DEFAULT_FACTOR = 1.10


def hourly_profiles(readings: DataFrame, *, ts: str = "polled_at", tz: str | None = None):
    """Average ratio and times per corridor, weekday and hour."""
    at = F.col(ts)
    return readings.groupBy(
        "corridor_id", "corridor_name",
        day_of_week(at, tz).alias("day_of_week"), hour_of_day(at, tz).alias("hour"),
    ).agg(
        F.avg("congestion_ratio").alias("avg_congestion_ratio"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.avg("static_duration_seconds").alias("avg_static_duration_seconds"),
        F.stddev("congestion_ratio").alias("stddev_congestion_ratio"),
        F.count(F.lit(1)).alias("sample_count"),
    )


def seasonal_factors(
    readings: DataFrame, month: int = SEASON_MONTH, *, ts: str = "polled_at", tz: str | None = None
) -> DataFrame:
    """Congestion of one month over the mean of all months, per corridor.

    Months are averaged first, so the second step sees at most 12 rows per
    corridor; the asked month is picked in that same step.
    """
    monthly = readings.groupBy(
        "corridor_id", F.month(local_time(F.col(ts), tz)).alias("month")
    ).agg(F.avg("congestion_ratio").alias("monthly_avg_congestion"))
    chosen = F.max(F.when(F.col("month") == month, F.col("monthly_avg_congestion")))
    return (
        monthly.groupBy("corridor_id")
        .agg((chosen / F.avg("monthly_avg_congestion")).alias("seasonal_multiplier"))
        .filter(F.col("seasonal_multiplier").isNotNull())
    )


def _with_proxies(
    requests: DataFrame, profiles: DataFrame, proxies: DataFrame | None
) -> DataFrame:
    """Corridor to use and scale per request.

    A corridor without any profile is replaced by its proxy, scaled by the
    ratio of their lengths.  ``proxies`` has corridor_id, proxy_corridor_id and
    scale_factor.
    """
    if proxies is None:
        return requests.withColumn("used_corridor_id", F.col("corridor_id")).withColumn(
            "scale_factor", F.lit(1.0)
        )
    known = profiles.select("corridor_id").distinct().withColumn("direct", F.lit(True))
    direct = F.coalesce("direct", F.lit(False)) | F.col("proxy_corridor_id").isNull()
    return (
        requests.join(known, "corridor_id", "left")
        .join(proxies, "corridor_id", "left")
        .withColumn(
            "used_corridor_id",
            F.when(direct, F.col("corridor_id")).otherwise(F.col("proxy_corridor_id")),
        )
        .withColumn("scale_factor", F.when(direct, 1.0).otherwise(F.col("scale_factor")))
        .drop("direct", "proxy_corridor_id")
    )


def predict_travel_time(
    requests: DataFrame,
    profiles: DataFrame,
    factors: DataFrame,
    *,
    proxies: DataFrame | None = None,
    default_factor: float = DEFAULT_FACTOR,
) -> DataFrame:
    """Predicted seconds with a band for each (corridor_id, day_of_week, hour).

    The band is one standard deviation of the ratio around the prediction, not
    below free flow.  Every request gives a row; ``data_source`` tells whether
    its figures come from the corridor itself, from its proxy, or from nowhere
    (then they are NULL).  A proxy stands in for a corridor without any profile
    at all, not for single hours that are missing.
    """
    used = _with_proxies(requests, profiles, proxies)
    profile = profiles.withColumnRenamed("corridor_id", "used_corridor_id").drop("corridor_name")
    factor = factors.select(
        F.col("corridor_id").alias("used_corridor_id"), "seasonal_multiplier"
    )
    joined = used.join(profile, ["used_corridor_id", "day_of_week", "hour"], "left").join(
        factor, "used_corridor_id", "left"
    )
    own = F.col("used_corridor_id").eqNullSafe(F.col("corridor_id"))
    scale = F.col("scale_factor")
    season = F.coalesce("seasonal_multiplier", F.lit(default_factor))
    free_flow = F.col("avg_static_duration_seconds") * scale
    predicted = F.col("avg_duration_seconds") * scale * season
    band = F.coalesce("stddev_congestion_ratio", F.lit(0.0)) * free_flow
    return joined.select(
        "corridor_id", "used_corridor_id", "day_of_week", "hour",
        scale.alias("scale_factor"),
        free_flow.alias("free_flow_seconds"),
        predicted.alias("predicted_seconds"),
        F.greatest(predicted - band, free_flow).alias("low_seconds"),
        (predicted + band).alias("high_seconds"),
        (F.col("avg_congestion_ratio") * season).alias("congestion_ratio"),
        season.alias("seasonal_multiplier"),
        F.coalesce("sample_count", F.lit(0)).alias("sample_count"),
        F.when(F.col("sample_count").isNull(), "none").when(own, "direct").otherwise("proxy")
        .alias("data_source"),
    )


def day_profile(
    profiles: DataFrame,
    factors: DataFrame,
    corridor_id: str,
    day_of_week: int,
    *,
    scale_factor: float = 1.0,
    default_factor: float = DEFAULT_FACTOR,
) -> DataFrame:
    """Predicted and free-flow minutes for every hour of a weekday."""
    chosen = profiles.filter(
        (F.col("corridor_id") == corridor_id) & (F.col("day_of_week") == day_of_week)
    )
    season = F.coalesce("seasonal_multiplier", F.lit(default_factor))
    return (
        chosen.join(factors, "corridor_id", "left")
        .select(
            "hour",
            (F.col("avg_static_duration_seconds") * scale_factor / 60)
            .cast("float").alias("freeflow_minutes"),
            (F.col("avg_duration_seconds") * scale_factor * season / 60)
            .cast("float").alias("predicted_minutes"),
            "avg_congestion_ratio",
            "sample_count",
        )
        .orderBy("hour")
    )
