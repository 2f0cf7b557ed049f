"""Expectations on streams: rule counts by batch, and a stop when there are too many."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from headway.operators.quality import expect, violations


def expect_stream(
    df: DataFrame, rules: Mapping[str, str], action: str = "drop", *, name: str = "expectations"
) -> DataFrame:
    """``expect`` on a stream, with the rows and violations of every batch under ``name``.

    The counts are taken while the data passes and reach a ``StreamCounts``
    listener.  ``warn`` keeps all rows, ``drop`` those that satisfy every rule,
    ``fail`` ends the query at the first row that does not.  A name serves one
    place of a query.
    """
    seen = df.observe(name, F.count(F.lit(1)).alias("rows"), *violations(rules))
    return seen if action == "warn" else expect(seen, rules, action)


class StreamCounts(StreamingQueryListener):
    """Rule counts and late rows of the streams of a session, by query name or id.

    ``limits`` maps rules to the number of violations that may have been seen
    in all; the query that exceeds one is stopped after its batch.  Batches
    that run again after a restart are reported again under their own number
    and replace what was known of them.
    """

    def __init__(self, spark: SparkSession, limits: Mapping[str, int] | None = None):
        self._spark, self._limits = spark, dict(limits or {})
        self.batches: dict[str, dict[int, dict[str, dict[str, int]]]] = defaultdict(dict)
        self.late: dict[str, int] = defaultdict(int)
        self.stopped: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query = progress.name or str(progress.id)
        self.late[query] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        counts = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        if counts:
            self.batches[query][progress.batchId] = counts
        for rule, limit in self._limits.items():
            if query not in self.stopped and self.total(query).get(rule, 0) > limit:
                self.stopped[query] = rule
                running = self._spark.streams.get(str(progress.id))
                if running is not None:
                    running.stop()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query: str) -> dict[str, int]:
        """Counts of all batches seen so far, by rule; ``rows`` is the number of rows."""
        total: dict[str, int] = defaultdict(int)
        for named in self.batches[query].values():
            for counts in named.values():
                for rule, n in counts.items():
                    total[rule] += n
        return dict(total)
