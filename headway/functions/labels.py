"""Labels, classes and formatted names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes, thresholds, patterns and defaults that results depend on.
ROUTE_TYPES = {1: "subway", 2: "rail", 3: "bus", 4: "ferry"}
CORRIDOR_TYPES = {0: "tram", 1: "subway", 2: "rail", 3: "bus", 4: "ferry"}
CORRIDOR_TYPES_WITH_ON_DEMAND = {**CORRIDOR_TYPES, 715: "on_demand"}
SEVERITIES = ("free_flow", "light", "moderate", "heavy", "severe")
SEVERITY_LIMITS = (1.1, 1.3, 1.6, 2.0)
JAM_KMH = 8
SLOW_KMH = 15
CORRIDOR_ROUTE_PATTERN = r"route_(.+)_seg_\d+"
SNAPSHOT_PATTERN = r"(\d{4}-\d{2}-\d{2})"
DEFAULT_ROUTE_COLOR = "0000FF"
DEFAULT_CORRIDOR_COLOR = "0066cc"
DEFAULT_ROUTE_NAME = "unknown"
DEFAULT_ZONE = "Metro Vancouver"
BUS_LIMIT_KMH = 50
OTHER_LIMIT_KMH = 80
LANES = 2


def _lookup(code: Column, names: dict[int, str], default: str) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit(default))


def route_type_label(code: Column) -> Column:
    return _lookup(code, ROUTE_TYPES, "other")


def corridor_type_label(code: Column, *, on_demand: bool = False) -> Column:
    names = CORRIDOR_TYPES_WITH_ON_DEMAND if on_demand else CORRIDOR_TYPES
    return _lookup(code, names, "bus")


def congestion_severity(ratio: Column, *, null_label: str | None = "severe") -> Column:
    """Class of a congestion ratio; a missing ratio gets ``null_label``."""
    label = F.when(ratio.isNull(), F.lit(null_label))
    for limit, name in zip(SEVERITY_LIMITS, SEVERITIES):
        label = label.when(ratio < F.lit(limit), name)
    return label.otherwise(SEVERITIES[-1])


def congestion_level(kmh: Column) -> Column:
    return (
        F.when(kmh < JAM_KMH, "HIGH").when(kmh < SLOW_KMH, "MEDIUM").otherwise("LOW")
    )


def route_from_corridor(corridor_id: Column) -> Column:
    """Route short name inside a corridor id, empty when there is none."""
    return F.regexp_extract(corridor_id, CORRIDOR_ROUTE_PATTERN, 1)


def snapshot_from_path(path: Column) -> Column:
    return F.regexp_extract(path, SNAPSHOT_PATTERN, 1)


def default_if_blank(value: Column, default: str) -> Column:
    """``default`` for NULL and for the empty text."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def corridor_id(route: Column, number: Column) -> Column:
    return F.format_string("route_%s_seg_%d", route, number)


def corridor_name(route: Column, long_name: Column, number: Column) -> Column:
    named = F.format_string("%s %s (segment %d)", route, long_name, number)
    bare = F.format_string("Route %s (segment %d)", route, number)
    return F.when(F.coalesce(long_name, F.lit("")) != "", named).otherwise(bare)


def speed_limit(corridor_type: Column) -> Column:
    return F.when(corridor_type == "bus", BUS_LIMIT_KMH).otherwise(OTHER_LIMIT_KMH)
