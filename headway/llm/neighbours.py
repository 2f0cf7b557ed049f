"""Nearest neighbours by a vantage-point tree for each shard.

A tree node holds one vector, its vantage point, and the range of distances to it on either side.
By the triangle inequality a side can hold nothing nearer than the gap between the query's own
distance and that range; it is left out where factor * gap exceeds the k-th distance so far. Factor
1 is exact, larger ones visit less. Queries go through a tree together, in blocks.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.shared import tidy

LEAF = 256
# Queries that go through a tree together.
TOGETHER = 256
# Above the rounding of a distance in double precision, relative to its size.
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of a and b in double precision, components added in order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        gap = a[:, j] - b[:, j]
        total += gap * gap
    return np.sqrt(total)


class VantageTree:
    """A tree over distinct vectors, each with the up to `keep` smallest ids that have it.

    More ids of one vector than a search returns can never be returned, so they are left out.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keep: int):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        first = np.ones(len(ids), bool)
        first[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        group = np.cumsum(first) - 1
        place = np.arange(len(ids)) - np.flatnonzero(first)[group]
        self.points = vectors[first]
        self.ids = np.full((len(self.points), min(keep, int(place.max()) + 1)), -1, np.int64)
        few = place < keep
        self.ids[group[few], place[few]] = ids[few]
        self.known = np.zeros(self.ids.shape, bool)
        self.known[group[few], place[few]] = True
        self.order = np.arange(len(self.points))
        # A node: vantage point (-1: leaf), start and end in order, children, (low, high) of each.
        self.nodes: list[tuple] = []
        self._build()

    def _build(self) -> None:
        rng = np.random.default_rng(7)
        todo = [(0, len(self.points), None)]
        while todo:
            start, end, parent = todo.pop()
            me = len(self.nodes)
            if parent is not None:
                self.nodes[parent[0]][3][parent[1]] = me
            if end - start <= LEAF:
                self.nodes.append((-1, start, end, [], []))
                continue
            pick = start + int(rng.integers(end - start))
            self.order[[start, pick]] = self.order[[pick, start]]
            rest = self.order[start + 1 : end]
            d = distances(np.broadcast_to(self.points[self.order[start]], (len(rest), self.points.shape[1])), self.points[rest])
            half = len(rest) // 2
            split = np.argpartition(d, half)
            self.order[start + 1 : end] = rest[split]
            d = d[split]
            middle = start + 1 + half
            ranges = [(d[:half].min(), d[:half].max()), (d[half:].min(), d[half:].max())]
            self.nodes.append((int(self.order[start]), start, end, [0, 0], ranges))
            todo += [(start + 1, middle, (me, 0)), (middle, end, (me, 1))]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        """Distances and ids of the k nearest of each query; missing ones are infinitely far."""
        best_d = np.full((len(queries), k), np.inf)
        best_id = np.full((len(queries), k), np.iinfo(np.int64).max)

        square = (self.points * self.points).sum(axis=1)
        own_square = (queries * queries).sum(axis=1)

        def offer(active: np.ndarray, points: np.ndarray) -> np.ndarray:
            """Approximate distances; what may be near enough is measured exactly and kept."""
            scale = own_square[active, None] + square[points]
            rough = scale - 2 * (queries[active] @ self.points[points].T)
            near = rough <= best_d[active, -1:] ** 2 + SLACK * scale
            some = np.flatnonzero(near.any(axis=1))
            if len(some):
                near, who = near[some], active[some]
                row, column = np.nonzero(near)
                exact = np.full(near.shape, np.inf)
                exact[row, column] = distances(queries[who[row]], self.points[points[column]])
                ids = np.broadcast_to(self.ids[points].reshape(1, -1), (len(who), self.ids[points].size))
                far = np.repeat(exact, self.ids.shape[1], axis=1)
                far = np.where(self.known[points].reshape(1, -1) & (ids != query_ids[who, None]), far, np.inf)
                if far.shape[1] > 4 * k:  # what cannot be among the k nearest needs no sorting; ties stay
                    limit = np.partition(far, k - 1, axis=1)[:, k - 1 : k]
                    kept = far <= limit
                    wide = min(far.shape[1], int(kept.sum(axis=1).max()))
                    place = np.argsort(~kept, axis=1, kind="stable")[:, :wide]
                    far, ids = np.take_along_axis(far, place, 1), np.take_along_axis(ids, place, 1)
                all_d, all_id = np.hstack([best_d[who], far]), np.hstack([best_id[who], ids])
                order = np.lexsort((all_id, all_d), axis=-1)[:, :k]
                best_d[who] = np.take_along_axis(all_d, order, 1)
                best_id[who] = np.take_along_axis(all_id, order, 1)
            return np.sqrt(np.maximum(rough, 0))

        everyone = np.arange(len(queries))
        todo = [(0, everyone, np.zeros(len(queries)))]
        while todo:
            at, active, gap = todo.pop()
            near = factor * gap <= best_d[active, -1] * (1 + SLACK)
            active = active[near]
            if not len(active):
                continue
            vantage, start, end, children, ranges = self.nodes[at]
            if vantage < 0:
                offer(active, self.order[start:end])
                continue
            d = offer(active, np.array([vantage]))[:, 0]
            # Rough distances are off by less than this.
            off = 1e-6 * np.sqrt(own_square[active] + square[vantage])
            gaps = [np.maximum(0, np.maximum(low - d, d - high) - off) for low, high in ranges]
            inside_first = gaps[0] <= gaps[1]
            for side, mask in ((1, inside_first), (0, ~inside_first), (0, inside_first), (1, ~inside_first)):
                if mask.any():
                    todo.append((children[side], active[mask], gaps[side][mask]))
        return best_d, best_id


def _stack(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _tree(keep: int):
    @tidy
    def build(rows: pa.Table) -> pa.Table:
        tree = VantageTree(rows["vec_id"].to_numpy(), _stack(rows["vector"]), keep)
        return pa.table(
            {"dim": rows["dim"][:1], "shard": rows["shard"][:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())}
        )

    return build


def _search(k: int, factor: float):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = pickle.loads(batch["tree"][i].as_py())
                block = batch["block"][i].values
                for start in range(0, len(block), TOGETHER):
                    part = block.slice(start, TOGETHER)
                    ids = part.field("vec_id").to_numpy()
                    d, found = tree.search(ids, _stack(part.field("vector")), k, factor)
                    real = np.isfinite(d)
                    yield pa.record_batch(
                        [np.repeat(ids, k)[real.ravel()], found[real], d[real]], schema=schema
                    )

    return run


def nearest(
    rows: DataFrame, queries: str = "vec_id % 100 = 0", k: int = 10, factor: float = 1.0,
    shard_rows: int = 8192, block_rows: int = 4096,
) -> DataFrame:
    """The k nearest other rows of each query: query_id, rank, vec_id, score, nearest first.

    `rows` has vec_id and embedding; `queries` is a condition on vec_id that picks the query rows.
    The score is the Euclidean distance in double precision; ties go to the smaller vec_id. Rows
    whose id or vector is null, empty or zero, or has a null or non-finite component take no part.
    Of rows that repeat an id, the one with the smallest vector counts. Vectors of different length
    do not meet. Fewer candidates than k are all returned; no query or an empty table gives no row.
    With factor 1 nothing is missed. Every row is indexed; every shard meets every block of queries: a
    tree is sent once per `block_rows` queries, a query once per `shard_rows` rows.
    """
    vector = F.col("embedding").cast("array<double>")
    sound = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    items = sound.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    sizes = rows.selectExpr("count(1) AS n", f"count_if({queries}) AS q").first()
    shards = max(1, -(-sizes["n"] // shard_rows))
    blocks = max(1, -(-sizes["q"] // block_rows))
    slot = lambda seed, n: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    trees = (
        items.withColumn("shard", slot(1, shards))
        .groupBy("dim", "shard")
        .applyInArrow(_tree(k + 1), "dim int, shard int, tree binary")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    asked = (
        items.filter(queries)
        .groupBy("dim", slot(2, blocks).alias("number"))
        .agg(F.collect_list(F.struct("vec_id", "vector")).alias("block"))
    )
    found = (
        trees.join(asked, ["dim", "number"])
        .repartition(shards * blocks, "shard", "number")
        .select("tree", "block")
        .mapInArrow(_search(k, factor), "query_id bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
