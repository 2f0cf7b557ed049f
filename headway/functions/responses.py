"""Stored routing responses: JSON fields, durations, traffic level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.schemas import ROUTE_RESPONSE

# Fixed value: share of intervals above which a response counts as jammed or slow.
LEVEL_SHARE = 0.3


def parsed_response(text: Column) -> Column:
    return F.from_json(text, ROUTE_RESPONSE)


def parse_duration(text: Column) -> Column:
    """``'123s'`` to 123; anything unreadable is NULL."""
    return F.rtrim(text, F.lit("s")).try_cast("int")


def congestion_ratio(duration: Column, static: Column) -> Column:
    """Travel time over free-flow time, 4 digits; NULL when either is missing or zero."""
    usable = (duration != 0) & (static > 0)
    return F.when(usable, F.round(duration / static, 4))


def traffic_level(intervals: Column) -> Column:
    """HIGH or MEDIUM when more than 30 % of the intervals are jammed or slow."""
    def share(speed: str) -> Column:
        return F.try_divide(
            F.size(F.filter(intervals, lambda i: i["speed"] == speed)).cast("double"),
            F.size(intervals).cast("double"),
        )

    return (
        F.when(share("TRAFFIC_JAM") > LEVEL_SHARE, "HIGH")
        .when(share("SLOW") > LEVEL_SHARE, "MEDIUM")
        .otherwise("LOW")
    )


_POINTS = T.StructType(
    [T.StructField(name, T.ArrayType(T.DoubleType())) for name in ("lat", "lon")]
)


def _decoded(texts: pa.Array) -> pa.Array:
    """Points of a batch of encoded polylines, all texts decoded in one sweep.

    A text is a row of numbers, latitude and longitude steps in turn; a number
    is a run of 5-bit groups, lowest first, that ends at the first byte below
    95, and its lowest bit is the sign.
    """
    # A text with other bytes than the encoding uses is no polyline: NULL.
    known = pc.and_(texts.is_valid(), pc.match_substring_regex(texts, "^[?-~]*$").fill_null(False))
    texts = pc.if_else(known, texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lengths = np.diff(offsets)
    body = texts.buffers()[2] if lengths.any() else b""
    groups = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]].astype(np.int64) - 63
    closes = groups < 32
    closes[np.cumsum(lengths)[lengths > 0] - 1] = True
    last = np.flatnonzero(closes)
    first = np.concatenate(([0], last[:-1] + 1)) if last.size else last
    place = np.arange(groups.size) - np.repeat(first, last - first + 1)
    bits = (groups & 31) << (5 * place)
    numbers = np.add.reduceat(bits, first) if last.size else bits
    steps = (numbers >> 1) ^ -(numbers & 1)

    bounds = np.searchsorted(last, np.concatenate(([0], np.cumsum(lengths))))
    counts = np.diff(bounds)
    pairs = counts // 2
    turn = np.arange(steps.size) - np.repeat(bounds[:-1], counts)
    whole = turn < np.repeat(2 * pairs, counts)
    offsets = np.concatenate(([0], np.cumsum(pairs)))

    def axis(parity: int) -> pa.Array:
        chosen = steps[whole & (turn % 2 == parity)]
        running = np.cumsum(chosen)
        before = np.concatenate(([0], running))[offsets[:-1]]
        degrees = (running - np.repeat(before, pairs)) / 1e5
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(degrees))

    return pa.StructArray.from_arrays(
        [axis(0), axis(1)], names=["lat", "lon"], mask=pc.invert(known)
    )


@F.arrow_udf(_POINTS)
def decode_polyline(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Coordinates of an encoded polyline as two lists, ``lat`` and ``lon``."""
    for texts in batches:
        yield _decoded(texts)
