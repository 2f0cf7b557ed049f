"""Newest row per key, newest snapshot, and other keep-the-first operators.

``row_number() == 1`` (or ``<= k``) is planned by Spark with a partial group
limit in front of the shuffle: every task forwards at most k rows per key, so
a hot key costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1
) -> DataFrame:
    """First ``k`` rows of every key in the given (total) order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= k).drop(_RANK)


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str] = ("corridor_id", "polled_at"),
    newest: Sequence[str] = ("_file_arrival_time",),
) -> DataFrame:
    """One row per key, the one that sorts last by ``newest``."""
    return top_per_key(df, keys, [F.desc_nulls_last(c) for c in newest])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in ascending order."""
    columns = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order]
    return top_per_key(df, keys, columns)


def latest_positions(positions: DataFrame, *, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest position of every vehicle."""
    return dedupe_latest(positions, ["id"], ["ts", *tie_break])


def latest_snapshot(
    df: DataFrame, column: str = "gtfs_snapshot_date", *, of: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest snapshot, found in ``of`` when that is another table.

    The maximum is a scalar subquery, so on a table partitioned by the snapshot
    column only the newest partition is read.
    """
    newest = (df if of is None else of).agg(F.max(column).alias("newest")).scalar()
    return df.filter(F.col(column) == newest)


def newest_if_dated(df: DataFrame, column: str = "gtfs_snapshot_date") -> DataFrame:
    """Rows of the newest snapshot where rows are dated; other tables as they are."""
    return latest_snapshot(df, column) if column in df.columns else df


def missing_keys(required: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Required keys that are not there yet."""
    return required.join(have.select(*keys), list(keys), "left_anti")


def dedupe_segments(
    segments: DataFrame,
    order: Sequence[str],
    coordinates: Sequence[str] = ("origin_lat", "origin_lon", "dest_lat", "dest_lon"),
    digits: int = 4,
) -> DataFrame:
    """One segment per rounded end points, the first by ``order``."""
    keys = [f"__{c}" for c in coordinates]
    rounded = segments.withColumns(
        {k: F.bround(F.col(c), digits) for k, c in zip(keys, coordinates)}
    )
    return distinct_on(rounded, keys, order).drop(*keys)
