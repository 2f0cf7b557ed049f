"""Row filters, casts and expectations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Plausibility limits of a schedule segment, rules on keys and values.
MAX_SEGMENT_SECONDS = 7200

STOP_KEY = {"stop_id_not_null": "stop_id IS NOT NULL"}
ROUTE_KEY = {"route_id_not_null": "route_id IS NOT NULL"}
LATITUDE_RULES = {"latitude_in_area": "stop_lat BETWEEN 48 AND 50"}
LONGITUDE_RULES = {"longitude_in_area": "stop_lon BETWEEN -124 AND -122"}
READING_RULES = {
    "ratio_at_least_one": "congestion_ratio >= 1.0",
    "duration_positive": "duration_seconds > 0",
}
SEGMENT_RULES = {
    "segment_positive": "scheduled_segment_seconds > 0",
    "distance_not_negative": "segment_distance_km >= 0",
}


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed projection; values that do not fit become NULL."""
    return df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in types.items()])


def select_except(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def drop_failed_polls(readings: DataFrame) -> DataFrame:
    """Readings with a key and a response that is no error report."""
    answered = ~F.col("api_response_json").contains('"error"')
    return readings.filter(
        answered & F.col("corridor_id").isNotNull() & F.col("polled_at").isNotNull()
    )


def plausible_segments(
    segments: DataFrame, lo: int = 0, hi: int = MAX_SEGMENT_SECONDS
) -> DataFrame:
    seconds = F.col("scheduled_segment_seconds")
    return segments.filter((seconds > lo) & (seconds < hi))


def non_terminal(segments: DataFrame) -> DataFrame:
    """Segments that have a next stop and both clock texts."""
    return segments.dropna(subset=["dest_stop_id", "departure_time", "dest_arrival_time"])


def filter_route(df: DataFrame, route: str, column: str = "route_short_name") -> DataFrame:
    return df.filter(F.lower(F.col(column)) == F.lower(F.lit(route)))


def violations(rules: Mapping[str, str]) -> list[Column]:
    """Counters of rows that break each rule; NULL counts as broken."""
    return [
        F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(name)
        for name, rule in rules.items()
    ]


def expect(
    df: DataFrame,
    rules: Mapping[str, str],
    action: str = "drop",
    *,
    observation: Observation | None = None,
) -> DataFrame:
    """Apply row expectations.

    ``drop`` keeps rows that satisfy every rule, ``fail`` stops the job at the
    first row that does not, ``warn`` keeps all rows and counts the violations
    in ``observation`` while the data passes (no extra job).
    """
    if action == "warn":
        counters = violations(rules)
        return df.observe(observation or Observation("expectations"), *counters)
    if action == "drop":
        for rule in rules.values():
            df = df.filter(F.expr(rule))
        return df
    if action == "fail":
        for name, rule in rules.items():
            broken = ~F.coalesce(F.expr(rule), F.lit(False))
            alarm = F.raise_error(F.lit(f"expectation failed: {name}")).cast("boolean")
            df = df.filter(F.when(broken, alarm).otherwise(F.lit(True)))
        return df
    raise ValueError(f"unknown action {action!r}")


def violation_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row with the number of violations per rule."""
    return df.agg(*violations(rules))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table, one row each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
        for name, df in tables.items()
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
