"""Gold figures that grow by batch: mergeable parts per corridor, day and hour.

A part holds counts, sums, maxima and a quantile sketch. Parts of the same key
add up, so a refresh reads the new readings and the stored parts of the days
they fall on, no older readings. ``refresh_days`` recomputes a day exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.labels import SEVERITIES
from headway.operators.traffic import PATTERN_KEYS
from headway.streaming.tables import _start, merge_batch

DAY = "poll_date"
KEYS = [*PATTERN_KEYS, DAY]
MEASURES = ("congestion_ratio", "duration_seconds", "static_duration_seconds", "distance_meters")
# Size of a sketch: at 512 a quantile is off by less than 0.6 % of the ranks, with a chance of 99 %.
SKETCH_K = 512


def reading_parts(readings: DataFrame, *, sketch_k: int = SKETCH_K) -> DataFrame:
    """Mergeable figures of readings per corridor, day and hour."""
    severity = F.col("congestion_severity")
    return readings.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("readings"),
        *[F.count(c).alias(f"{c}_n") for c in MEASURES],
        *[F.sum(F.col(c).cast("double")).alias(f"{c}_sum") for c in MEASURES],
        F.max("congestion_ratio").alias("peak"),
        *[F.count_if(severity == name).alias(f"{name}_count") for name in SEVERITIES],
        F.kll_sketch_agg_double(F.col("congestion_ratio").cast("double"), sketch_k).alias("ratios"),
    )


def _merged(parts: DataFrame) -> list[Column]:
    added = [c for c in parts.columns if c not in (*KEYS, "peak", "ratios")]
    return [
        *[F.sum(c).alias(c) for c in added],
        F.max("peak").alias("peak"),
        F.kll_merge_agg_double("ratios").alias("ratios"),
    ]


def merge_parts(parts: DataFrame) -> DataFrame:
    """One row per key of parts that were taken from different readings."""
    return parts.groupBy(*KEYS).agg(*_merged(parts)).select(*parts.columns)


def _average(measure: str, digits: int) -> Column:
    return F.round(F.col(f"{measure}_sum") / F.col(f"{measure}_n"), digits).alias(f"avg_{measure}")


def _quantile(p: float) -> Column:
    full = F.col("congestion_ratio_n") > 0
    return F.when(full, F.round(F.kll_sketch_get_quantile_double("ratios", F.lit(p)), 3))


def daily_from_parts(parts: DataFrame) -> DataFrame:
    """``corridor_daily`` of the readings that the parts were taken from."""
    return parts.groupBy("corridor_id", "corridor_name", DAY, "day_type").agg(*_merged(parts)).select(
        "corridor_id", "corridor_name", DAY, "day_type", F.col("readings").alias("num_readings"),
        _average("congestion_ratio", 3), F.round("peak", 3).alias("peak_congestion_ratio"),
        *[_average(c, 0) for c in MEASURES[1:]],
    )


def patterns_from_parts(parts: DataFrame) -> DataFrame:
    """``congestion_patterns`` from parts; median and 95th percentile are those of the sketch."""
    return parts.groupBy(*PATTERN_KEYS).agg(*_merged(parts)).select(
        *PATTERN_KEYS, F.col("readings").alias("num_observations"), _average("congestion_ratio", 3),
        _quantile(0.5).alias("median_congestion_ratio"), _quantile(0.95).alias("p95_congestion_ratio"),
        _average("duration_seconds", 0), _average("distance_meters", 0),
        *[f"{name}_count" for name in SEVERITIES],
    )


def merge_readings(batch: DataFrame, batch_id: int, target: str, *, buckets: int = 4096, sketch_k: int = SKETCH_K) -> None:
    """Add a micro-batch of readings to the stored parts; a batch that runs again adds nothing.

    Days are dealt to buckets, so a batch reads and rewrites the parts of its
    own days, and of the few others that share a bucket with them.
    """

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return new if old is None else merge_parts(old.unionByName(new))

    parts = reading_parts(batch, sketch_k=sketch_k)
    merge_batch(parts, batch_id, [DAY], merge, target=target, buckets=buckets)


def gold_stream(
    readings: DataFrame, *, target: str, checkpoint: str, buckets: int = 4096, trigger: str | None = None
) -> StreamingQuery:
    """Keep the parts of ``target`` up to date with a stream of readings."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_readings(batch, batch_id, target, buckets=buckets)

    writer = readings.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, trigger)
