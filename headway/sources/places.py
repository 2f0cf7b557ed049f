"""Tables stored by place, so that a look-up in a small box reads few files.

Rows lie in folders by zone, a square of ``zone`` degrees, and are sorted inside
a file along a Z-order curve.  A box selects zones by their folder names and row
groups by the range of their coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE_LAT, ZONE_LON = "zone_lat", "zone_lon"
ZONE_DEGREES = 0.1
# Bits of either coordinate inside a zone that the curve takes turns in.
CURVE_BITS = 12


def z_order(lat: Column, lon: Column, zone: float = ZONE_DEGREES, bits: int = CURVE_BITS) -> Column:
    """Place of a point on the curve inside its zone."""
    steps = 1 << bits

    def inside(degrees: Column) -> Column:
        part = degrees / zone - F.floor(degrees / zone)
        return F.least(F.floor(part * steps), F.lit(steps - 1)).cast("long")

    place = F.lit(0).cast("long")
    for source, shift in ((inside(lon), 0), (inside(lat), 1)):
        for bit in range(bits):
            one = F.shiftright(source, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, 2 * bit + shift))
    return place


def save_by_place(df: DataFrame, path: str, lat: str, lon: str, *, zone: float = ZONE_DEGREES) -> None:
    """Write a table by zone; a zone with very many rows is written by several tasks.

    Rows without coordinates lie in a zone of their own and are in no box.
    """
    zoned = df.withColumns(
        {
            ZONE_LAT: F.floor(F.col(lat) / zone).cast("int"),
            ZONE_LON: F.floor(F.col(lon) / zone).cast("int"),
            "__curve": z_order(F.col(lat), F.col(lon), zone),
        }
    )
    (
        zoned.repartitionByRange(ZONE_LAT, ZONE_LON, "__curve")
        .sortWithinPartitions(ZONE_LAT, ZONE_LON, "__curve")
        .drop("__curve")
        .write.mode("overwrite").partitionBy(ZONE_LAT, ZONE_LON).parquet(path)
    )


def read_box(
    spark: SparkSession, path: str, lat: str, lon: str,
    box: tuple[float, float, float, float], *, zone: float = ZONE_DEGREES,
) -> DataFrame:
    """Rows of a table stored by place inside a box of south, west, north and east."""
    south, west, north, east = box

    def zones(column: str, low: float, high: float) -> Column:
        return F.col(column).between(F.floor(F.lit(low) / zone), F.floor(F.lit(high) / zone))

    return (
        spark.read.parquet(path)
        .filter(zones(ZONE_LAT, south, north) & zones(ZONE_LON, west, east))
        .filter(F.col(lat).between(south, north) & F.col(lon).between(west, east))
        .drop(ZONE_LAT, ZONE_LON)
    )
