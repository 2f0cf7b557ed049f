"""Traffic readings that grow by batch, from a stream of raw polls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.quality import drop_failed_polls
from headway.plans.traffic import classified_readings

POLL = ["corridor_id", "polled_at"]


def stream_readings(
    raw: DataFrame,
    *,
    delay: str = "1 hour",
    keep: str = "newest",
    tz: str | None = None,
    newest: tuple[str, ...] = ("_file_arrival_time",),
    null_label: str | None = "severe",
) -> DataFrame:
    """``traffic_readings`` of a stream whose polls are up to ``delay`` late.

    ``newest`` gives a poll out when the watermark has passed its time, as the
    delivery that sorts last by ``newest``; deliveries are reduced to one per
    poll and task before the shuffle.  ``first`` gives the delivery that comes
    first at once and drops the others.  Polls behind the watermark are dropped
    and counted by Spark (``streaming.quality.StreamCounts.late``).
    """
    polls = drop_failed_polls(raw).withWatermark("polled_at", delay)
    if keep == "first":
        once = polls.dropDuplicatesWithinWatermark(POLL)
    elif keep == "newest":
        row = F.struct(*[F.col(f"`{c}`") for c in polls.columns])
        last = F.max_by(row, F.struct(*newest)).alias("row")
        once = polls.groupBy(*POLL).agg(last).select("row.*")
    else:
        raise ValueError(f"unknown rule {keep!r}")
    return classified_readings(once, tz=tz, null_label=null_label)
