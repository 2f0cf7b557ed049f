"""Vehicle speeds over a stream of positions.

Spark's state store holds, per vehicle and half-hour slice, the positions that
the watermark has not passed and the last one that it has.  A position is given
out once the watermark has passed it, so late ones within the delay find their
place; what comes later still is dropped and counted by Spark.  The state only
finds the position before; the speed itself is the batch expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headway.operators.vehicles import MAX_GAP_S, SLICE_S, cut_slices, speeds_from_previous
from headway.streaming.tables import run_stream

_OUT = "row string, __ts double, __lat double, __lon double"
_GAP_US = MAX_GAP_S * 1_000_000
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(held))).read_all().to_pandas()


def _with_previous(tie_break: Sequence[str]):
    order = ["us", *tie_break]

    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark_ms = state.getCurrentWatermarkMs()
        mark = mark_ms * 1000
        frames = [part.assign(given=False) for part in parts if len(part)]
        if state.exists:
            frames.insert(0, _unpacked(state.get[0]))
        rows = pd.concat(frames, ignore_index=True).sort_values(
            order, na_position="first", kind="stable", ignore_index=True
        )
        before = rows[["t", "lat", "lon"]].shift()
        settled = rows["us"] <= mark
        ready = settled & ~rows["given"].astype(bool) & rows["mine"].astype(bool)
        waiting = rows[~settled]
        last = rows[settled].tail(1).assign(given=True)
        last = last[last["us"] + _GAP_US > mark]  # nothing that still may come is near enough to others
        if len(waiting) or len(last):
            state.update((_packed(pd.concat([last, waiting], ignore_index=True)),))
            due = int(waiting["us"].min() if len(waiting) else last["us"].iloc[0] + _GAP_US)
            state.setTimeoutTimestamp(max(-(-due // 1000), mark_ms + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(
            {"row": rows["row"], "__ts": before["t"], "__lat": before["lat"], "__lon": before["lon"]}
        )[ready]

    return step


def stream_vehicle_speeds(
    positions: DataFrame,
    *,
    delay: str = "2 minutes",
    tie_break: Sequence[str] = (),
    slice_s: int = SLICE_S,
) -> DataFrame:
    """``vehicle_speeds`` of a stream whose rows are up to ``delay`` late.

    The state of a group is bounded by one vehicle's rows within the delay; a
    vehicle that falls silent leaves it once no row could refer to it.  Rows
    without a time are dropped, as in a batch.  ``positions`` must not carry a
    watermark of its own.
    """
    at = F.col("ts").cast("double")
    us = F.round(at * 1_000_000).cast("long")
    ties = {f"tie_{n}": F.col(c) for n, c in enumerate(tie_break)}
    timed = cut_slices(positions, slice_s).filter(at.isNotNull()).select(
        F.col("id").alias("vehicle"),
        F.col("__slice").alias("part"),
        (F.col("__slice") == F.col("__own")).alias("mine"),
        F.timestamp_micros(us).alias("at"),
        us.alias("us"),
        at.alias("t"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        *[column.alias(name) for name, column in ties.items()],
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in positions.columns]), _JSON).alias("row"),
    )
    found = (
        timed.withWatermark("at", delay)
        .groupBy("vehicle", "part")
        .applyInPandasWithState(
            _with_previous(list(ties)), _OUT, "held binary", "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    whole = F.from_json("row", positions.schema, _JSON).alias("row")
    return speeds_from_previous(found.select(whole, "__ts", "__lat", "__lon").select("row.*", "__ts", "__lat", "__lon"))


def run_vehicle_speeds(
    positions: DataFrame,
    *,
    target: str,
    checkpoint: str,
    delay: str = "2 minutes",
    tie_break: Sequence[str] = (),
    trigger: str | None = None,
) -> StreamingQuery:
    """Append the speeds of ``stream_vehicle_speeds`` to a table, exactly once."""
    speeds = stream_vehicle_speeds(positions, delay=delay, tie_break=tie_break)
    return run_stream(speeds, target, checkpoint, trigger=trigger)
