"""Python data source that polls a routing service for every corridor.

    spark.dataSource.register(CorridorPollSource)
    spark.read.format("corridor_poll").options(corridors_path=..., transport="pkg.mod:fetch")

The corridor list is read by Spark, so it can lie in any store that Spark reads; ``corridors_json``
gives it inline instead. ``transport`` names a function that takes a corridor (a dict) and the options,
and returns the service's answer as JSON text.  It runs on the executors; each
corridor slice is a partition of its own.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.error import HTTPError

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from headway.schemas import TRAFFIC_READING
from headway.sources.traffic import corridor_records

# Longest pause between two tries; poll interval.
MAX_BACKOFF_S = 30.0
POLL_INTERVAL_S = 900


def is_retryable(error: Exception) -> bool:
    """Overload, server and transport errors; other HTTP errors are final."""
    if isinstance(error, HTTPError):
        return error.code == 429 or error.code >= 500
    return isinstance(error, OSError)


def fetch_with_retry(
    fetch: Callable[[], str],
    *,
    max_retries: int = 3,
    initial_backoff: float = 1.0,
    sleep: Callable[[float], None] = time.sleep,
) -> str:
    """Answer of ``fetch``, tried again with doubling pauses.

    When all tries fail the answer is an error report, so that one corridor
    cannot fail a whole poll.
    """
    pause = initial_backoff
    for left in range(max_retries, -1, -1):
        try:
            return fetch()
        except Exception as error:
            if left == 0 or not is_retryable(error):
                return json.dumps({"error": str(error)})
        sleep(min(pause, MAX_BACKOFF_S))
        pause *= 2
    raise AssertionError("unreachable")


def _seconds(text: str | None) -> int | None:
    return int(text.rstrip("s")) if text else None


def travel_figures(answer: str) -> tuple[int | None, int | None, int | None, float | None]:
    """Duration, free-flow duration, distance and ratio of an answer's first route."""
    first = next(iter(json.loads(answer).get("routes") or ()), {})
    now, free = _seconds(first.get("duration")), _seconds(first.get("staticDuration"))
    ratio = round(now / free, 4) if now and free and free > 0 else None
    return now, free, first.get("distanceMeters"), ratio


@dataclass
class CorridorSlice(InputPartition):
    """Corridors of one partition and the time of the poll they belong to."""

    corridors: list[dict]
    polled_at: datetime


def _listed(corridors_json: str | None) -> list[dict]:
    if not corridors_json:
        raise ValueError("corridors_json is required; poll_options reads it from a path")
    return json.loads(corridors_json)


def poll_options(spark: SparkSession, path: str, **options: str) -> dict[str, str]:
    """Options for the source with the corridor list that Spark reads from a path.

    A list has some hundred corridors: as many as one poll can ask for.
    """
    listed = [row.asDict(recursive=True) for row in corridor_records(spark, path).collect()]
    return {"corridors_json": json.dumps(listed), **options}


class _Poller:
    def __init__(self, options: dict[str, str]):
        corridors = _listed(options.get("corridors_json"))
        self.options = {k: v for k, v in options.items() if k != "corridors_json"}
        slices = max(1, int(options.get("slices", "8")))
        self.parts = [part for i in range(slices) if (part := corridors[i::slices])]

    def __getstate__(self) -> dict:
        # A task gets its corridors with its partition, not the whole list.
        return {"options": self.options, "parts": []} | {
            k: v for k, v in self.__dict__.items() if k not in ("options", "parts")
        }

    def sliced(self, polled_at: datetime) -> list[CorridorSlice]:
        return [CorridorSlice(part, polled_at) for part in self.parts]

    def read(self, partition: CorridorSlice) -> Iterator[tuple]:
        module, _, name = self.options["transport"].partition(":")
        transport = getattr(importlib.import_module(module), name)
        for corridor in partition.corridors:
            answer = fetch_with_retry(
                lambda: transport(corridor, self.options),
                max_retries=int(self.options.get("max_retries", "3")),
                initial_backoff=float(self.options.get("initial_backoff", "1.0")),
            )
            try:
                figures = travel_figures(answer)
            except (ValueError, AttributeError, TypeError) as error:
                answer = json.dumps({"error": str(error)})
                figures = (None, None, None, None)
            start, end = corridor["origin"], corridor["destination"]
            yield (
                corridor["corridor_id"], corridor["corridor_name"],
                start["lat"], start["lng"], end["lat"], end["lng"],
                *figures, answer, partition.polled_at,
            )


class CorridorPollReader(_Poller, DataSourceReader):
    def partitions(self) -> list[CorridorSlice]:
        return self.sliced(datetime.now(timezone.utc))


class CorridorPollStreamReader(_Poller, DataSourceStreamReader):
    """One poll per time bucket.

    The offset is the number of the current interval since the epoch, so it
    only moves with the clock and means the same after a restart.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.interval = float(options.get("poll_interval_seconds", str(POLL_INTERVAL_S)))

    def _bucket(self) -> int:
        return int(time.time() // self.interval)

    def initialOffset(self) -> dict:
        return {"poll": self._bucket() - 1}

    def latestOffset(self) -> dict:
        return {"poll": self._bucket()}

    def partitions(self, start: dict, end: dict) -> list[CorridorSlice]:
        # Intervals missed while the stream was down cannot be polled any more.
        if end["poll"] <= start["poll"]:
            return []
        at = datetime.fromtimestamp(end["poll"] * self.interval, timezone.utc)
        return self.sliced(at)

    def commit(self, end: dict) -> None:
        pass


class CorridorPollSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corridor_poll"

    def schema(self) -> str:
        return TRAFFIC_READING

    def reader(self, schema) -> CorridorPollReader:
        return CorridorPollReader(self.options)

    def streamReader(self, schema) -> CorridorPollStreamReader:
        return CorridorPollStreamReader(self.options)
