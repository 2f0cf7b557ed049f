"""Connected components by alternating stars: a distributed union-find.

Each round joins every node to the smallest of its neighbours, first for the larger neighbours, then
for the smaller ones, until every node points at the smallest of its component. Rounds are written
to the shared folder; nothing but a count and a checksum comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with b < a. Joined to the smallest neighbour by aggregates, so hot nodes split."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        near = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = near.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the (a, b) edges; component is the smallest id reachable.

    Edges need no order; repeated ones and loops are harmless. Ids without an edge to another id
    are not listed.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    pairs = stored(pairs)
    state = _state(pairs)
    while state[0]:
        pairs = stored(_star(stored(_star(pairs, large=True)), large=False))
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("b").alias("id")).distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
