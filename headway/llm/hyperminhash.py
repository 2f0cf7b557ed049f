"""Near-duplicate documents by HyperMinHash.

A document's shingles are dealt by hash into buckets. A register keeps of a bucket's smallest hash
only the number of leading zeros and some mantissa bits. Groups of registers are bands; an empty
bucket borrows a register by a fixed order of the others, so short documents have all bands too.
Documents that share a band are candidates:

1. Each one meets the document that is the first in most of its bands. Pairs whose registers cannot come from
   similar sets (matching ones, corrected for chance collisions) go; the others are verified on their
   whole sets. What is linked is contracted to components, so groups of copies cost a pair a member.
2. Bands whose documents still lie in several components are taken whole: by size, as similar sets
   have similar sizes, and in chunks, in which all pairs of different components are tested in place:
   by registers, which leaves the documents with a possible partner, and then these on their sets.
   Nothing but links comes out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.blocks import NO_ID, Block, mixed
from headway.llm.components import components
from headway.llm.jaccard_join import shingles
from headway.llm.shared import grouped, sliced, stored, tidy

BUCKETS, MANTISSA = 128, 10
BAND = 4
BATCH_BYTES = 8 << 20
# A pair is left out on its registers alone if similar sets had these by a chance of 1 in 10^9.
SURE = math.log(1e9)
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SKETCHES = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()),
        ("registers", pa.binary()), ("bands", pa.list_(pa.int64())),
    ]
)
SKETCHES_DDL = "doc_id bigint, text_key bigint, n bigint, key1 bigint, key2 bigint, registers binary, bands array<bigint>"


def registers(doc: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
    """(docs x BUCKETS) registers of (document, shingle) rows: leading zeros and one, then mantissa; 0 is empty."""
    value = mixed(value ^ np.uint64(0x5851F42D4C957F2D))
    least = np.full(docs * BUCKETS, np.iinfo(np.uint64).max)
    np.minimum.at(least, doc * BUCKETS + (value >> np.uint64(57)).astype(np.int64), value & np.uint64((1 << 57) - 1))
    empty = least == np.iinfo(np.uint64).max
    # 53 of the 57 bits, which a double holds.
    mantissa, bits = np.frexp((least >> np.uint64(4)).astype(np.float64))
    zeros = np.minimum(53 - bits, 53)
    found = (zeros + 1 << MANTISSA) + np.maximum((2 * mantissa - 1) * (1 << MANTISSA), 0).astype(np.int64)
    return np.where(empty, 0, found).astype(np.uint16).reshape(docs, BUCKETS)


# For each bucket the others in a fixed random order: where an empty one takes its register from.
_LENDERS = np.array([np.random.default_rng(100 + j).permutation(BUCKETS) for j in range(BUCKETS)])


def filled(own: np.ndarray) -> np.ndarray:
    """Registers with the empty ones borrowed; documents without any stay empty."""
    found = own.copy()
    row, column = np.nonzero((own == 0) & own.any(axis=1, keepdims=True))
    for step in range(BUCKETS):
        if not len(row):
            break
        taken = own[row, _LENDERS[column, step]]
        found[row, column] = taken
        left = taken == 0
        row, column = row[left], column[left]
    return found


# Bands beyond the plain ones, which short documents need: few shingles fill many of their buckets.
_MORE = np.array([np.random.default_rng(200 + k).permutation(BUCKETS) for k in range(1)]).reshape(-1)
SHORT = 2 * BUCKETS


def bands(own: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of a document; the first BUCKETS / BAND ones are those of longer documents."""
    whole = filled(own)
    groups = np.concatenate([whole, whole[:, _MORE]], axis=1).reshape(len(own), -1, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(groups.shape[1], dtype=np.uint64), groups.shape[:2]).copy()
    for j in range(BAND):
        key = (key << np.uint64(16) | key >> np.uint64(48)) * np.uint64(0x9E3779B97F4A7C15) ^ groups[:, :, j]
    return mixed(key).view(np.int64)


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that a bucket's registers agree though its smallest hashes differ, for sets of n and m.

    The sum over registers of the chances that either set's smallest hash falls into them; within
    one number of leading zeros registers are equally wide, and the sum over them is an integral.
    """
    a, b = n / BUCKETS, m / BUCKETS
    low = 0.5 ** np.arange(1, 54)
    total = (a + b)[..., None]
    part = np.exp(-total * low) - np.exp(-2 * total * low)
    return (a * b / (a + b)) * (part * low / (1 << MANTISSA)).sum(axis=-1)


def similarity(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated Jaccard similarity, number of buckets behind it) of pairs of rows of registers."""
    used = ((x > 0) | (y > 0)).sum(axis=1)
    same = ((x == y) & (x > 0)).sum(axis=1)
    chance = collisions(n.astype(float), m.astype(float))
    return np.clip((same / np.maximum(used, 1) - chance) / (1 - chance), 0, 1), used


def plausible(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs may have a similarity of `percent`: by their sizes, and by their registers."""
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    j, used = similarity(x, y, n, m)
    t = percent / 100
    with np.errstate(divide="ignore", invalid="ignore"):
        against = np.where(j > 0, j * np.log(j / t), 0) + np.where(j < 1, (1 - j) * np.log((1 - j) / (1 - t)), 0)
    return fits & ((j >= t) | (used * against < SURE))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _find(parent: dict[int, int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """A row a document: the size and key of its shingle set, registers and bands; no bands without shingles."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            doc, value = shingles(Block.of(batch.column("text").cast(pa.large_binary()), lower=True), size)
            docs = batch.num_rows
            n = np.bincount(doc, minlength=docs)
            some = np.flatnonzero(n)
            code = mixed(value)
            key1, key2 = np.zeros(docs, np.uint64), np.zeros(docs, np.uint64)
            if len(some):
                at = np.searchsorted(doc, some)
                key1[some] = np.add.reduceat(code, at)
                key2[some] = np.bitwise_xor.reduceat(code * np.uint64(0x9E3779B97F4A7C15), at)
            own = registers(doc, value, docs)
            keys, plain = bands(own), BUCKETS // BAND
            yield pa.record_batch(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(key1.view(np.int64)),
                    pa.array(key2.view(np.int64)), pa.array([x.tobytes() for x in own], pa.binary()),
                    pa.array([(k if m <= SHORT else k[:plain]) if m else [] for k, m in zip(keys, n.tolist(), strict=True)], pa.list_(pa.int64())),
                ],
                schema=SKETCHES,
            )

    return docs.mapInArrow(run, SKETCHES_DDL)


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, set) of (node, text) rows; set: the sorted fingerprints of the shingles."""
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            doc, value = shingles(Block.of(batch.column("text").cast(pa.large_binary()), lower=True), size)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).tolist()
            sets = [value[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.record_batch([batch.column("node"), pa.array(sets, pa.binary())], schema=schema)

    return texts.mapInArrow(run, "node bigint, set binary")


def _registers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def _batches(edges: Iterable[tuple[int, int]], limit: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for edge in edges:
        held.append(edge)
        if len(held) >= limit:
            yield pa.record_batch(list(zip(*held, strict=True)), schema=EDGES)
            held = []
    if held:
        yield pa.record_batch(list(zip(*held, strict=True)), schema=EDGES)


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked: by the estimate first, then on their whole sets."""
    side = lambda c, of: of.select(F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in of.columns if x != "node"))

    @tidy
    def estimate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy()  # noqa: E731, B023
            keep = plausible(_registers(batch.column("registers_a")), _registers(batch.column("registers_b")), get("n_a"), get("n_b"), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    @tidy
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = lambda c, i: np.frombuffer(batch.column(c)[i].as_py(), np.uint64)  # noqa: E731, B023
            keep = [linked(own("set_a", i), own("set_b", i), percent) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sketch = nodes.select("node", "n", "registers")
    ddl = "a bigint, b bigint"
    near = pairs.join(side("a", sketch), "a").join(side("b", sketch), "b").mapInArrow(estimate, ddl)
    return near.join(side("a", sets), "a").join(side("b", sets), "b").mapInArrow(verify, ddl)


class Rows:
    """The rows of one band, size class and pair of chunks, and which pairs of them are to be tested."""

    def __init__(self, rows: pa.Table, percent: int):
        get = lambda c: rows[c].to_numpy()
        self.node, self.n, self.component, self.low, self.side = get("node"), get("n"), get("component"), get("low"), get("side")
        self.percent = percent
        self.idle = bool((self.component == self.component[0]).all() or self.low.all())
        if self.idle:
            return
        self.apart = rows["first"][0].as_py() != rows["second"][0].as_py()
        self.registers = _registers(rows["registers"])
        self.bands = bands(self.registers)
        self.bands[self.n > SHORT, BUCKETS // BAND :] = 0
        self.here = int(np.flatnonzero(self.bands[0] == rows["band"][0].as_py())[0])

    def partners(self, i: int, component: np.ndarray) -> np.ndarray:
        """Later rows of other components that row i may be linked with."""
        # Each pair once: of two chunks one row each, of two size classes not both the lower.
        others = np.arange(i + 1, len(self.node))
        others = others[(component[others] != component[i]) & ~(self.low[others] & self.low[i])]
        if self.apart:
            others = others[self.side[others] != self.side[i]]
        if len(others) and self.here:  # and in the first band only that the two share
            before = self.bands[i, : self.here]
            others = others[~((self.bands[others, : self.here] == before) & (before != 0)).any(axis=1)]
        if len(others):
            same = np.full(len(others), i)
            r = self.registers
            others = others[plausible(r[same], r[others], self.n[same], self.n[others], self.percent)]
        return others


def hopeful(rows: pa.Table, percent: int) -> pa.Table:
    """The rows that may be linked with one of another component, by their registers."""
    own = Rows(rows, percent)
    found = np.zeros(rows.num_rows, bool)
    if not own.idle:
        for i in range(rows.num_rows):
            others = own.partners(i, own.component)
            found[others] = True
            found[i] |= len(others) > 0
    return rows.filter(pa.array(found))


def chunk_links(rows: pa.Table, percent: int) -> Iterator[tuple[int, int]]:
    """Links between components among the rows, on their whole sets."""
    own = Rows(rows, percent)
    if own.idle:
        return
    parent = {c: c for c in np.unique(own.component).tolist()}
    current = own.component.copy()
    for i in range(len(own.node)):
        others = own.partners(i, current)
        mine = np.frombuffer(rows["set"][i].as_py(), np.uint64) if len(others) else None
        for j in others.tolist():
            p, q = _find(parent, int(own.component[i])), _find(parent, int(own.component[j]))
            if p != q and linked(mine, np.frombuffer(rows["set"][j].as_py(), np.uint64), percent):
                parent[p] = q
                current[current == p] = q
                yield int(own.node[i]), int(own.node[j])


def rest(members: DataFrame, near: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, chunk: int) -> DataFrame:
    """Links within bands whose documents still lie in several components.

    The rows of a band's largest component only meet those of others, and are copied for each chunk of
    these; the others are copied for each chunk of either kind.
    """
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) * F.lit(1 - 1e-9)).cast("bigint")
    labelled = (
        members.join(near, members.node == near.id, "left")
        .select("band", "node", F.coalesce("component", "node").alias("component"))
    )
    several = labelled.groupBy("band").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p < q").select("band")
    sized = labelled.join(several, "band").join(nodes.select("node", "n"), "node").withColumn("class", size_class)
    # Similar sets are in one size class or in neighbouring ones: a row goes to its own and, as `low`, to the next.
    dealt = sized.withColumn("low", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("class", F.col("class") + F.col("low"))
    keys = ["band", "class"]
    weight = F.greatest(F.sum("rows") / F.lit(chunk), F.sum("held") / F.lit(chunk << 10))
    most = F.max(F.struct("rows", "held", "component"))
    parts = dealt.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("held"), F.min("low").alias("some"))
    groups = (
        parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), F.min("some").alias("some"), F.ceil(weight).alias("all"), F.sum("rows").alias("rows"), F.sum("held").alias("held"), most.alias("top"))
        .filter("parts > 1 AND some = 0")
        .select(
            *keys, F.when(F.col("all") > 1, F.col("top.component")).alias("main"),
            F.when(F.col("all") > 1, F.ceil(F.greatest(F.col("top.rows") / chunk, F.col("top.held") / (chunk << 10)))).otherwise(0).alias("mains"),
            F.when(F.col("all") > 1, F.ceil(F.greatest((F.col("rows") - F.col("top.rows")) / chunk, (F.col("held") - F.col("top.held")) / (chunk << 10)))).otherwise(1).alias("others"),
        )
    )
    count = lambda c: F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1)
    pair = lambda a, b: F.struct(a.cast("bigint").alias("first"), b.cast("bigint").alias("second"))
    in_main = F.col("component").eqNullSafe(F.col("main"))
    place = F.when(in_main, -1 - F.pmod(F.xxhash64("node"), "mains")).otherwise(F.pmod(F.xxhash64("node"), "others"))
    side = F.col("side")
    with_main = F.when(F.col("mains") > 0, F.transform(count("mains"), lambda i: pair(-1 - i, side))).otherwise(F.array().cast("array<struct<first:bigint,second:bigint>>"))
    chunks = F.when(in_main, F.transform(count("others"), lambda j: pair(side, j))).otherwise(
        F.concat(with_main, F.transform(count("others"), lambda j: pair(F.least(side, j), F.greatest(side, j))))
    )
    keys = [*keys, "first", "second"]
    spread = (
        dealt.join(groups, ["band", "class"]).withColumn("side", place).withColumn("to", F.explode(chunks))
        .select("band", "class", "to.first", "to.second", "node", "component", (F.col("low") == 1).alias("low"), "side")
        .join(nodes.select("node", "n", "registers"), "node")
    )

    @tidy
    def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, keys):
            if rows.num_rows > 1:
                yield from hopeful(rows, percent).to_batches()

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(edge for rows in grouped(batches, keys) if rows.num_rows > 1 for edge in chunk_links(rows, percent))

    together = lambda df: df.repartition(*keys).sortWithinPartitions(*keys)
    left = together(spread).mapInArrow(sift, spread.schema)
    return together(left.join(sets, "node")).mapInArrow(run, "a bigint, b bigint")


def near_dedup(docs: DataFrame, size: int = 4, percent: int = 80, chunk: int = 2048) -> DataFrame:
    """Connect documents whose shingle sets have 100 * intersection >= percent * union.

    Words are runs of other bytes than 0x20 and 0x09-0x0D with A-Z in lower case; a set holds the
    distinct shingles of `size` words, or the whole sequence of fewer words. Returns a row for each
    document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept
    (doc_id is component_id). Null texts and texts without words have no shingle and no link, and are
    kept. A null doc_id counts as larger than others; rows without an id, or that repeat one, are
    judged row by row and do not connect each other. Only doc_id and text are read; an empty table
    gives no row. Links are confirmed on whole sets, of 64-bit fingerprints. Documents become
    candidates by a shared band of BAND registers: a pair of similarity 0.8 has none by a chance of
    less than 1 in 10^6. `chunk` bounds the rows a group holds and does not change the result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text, F.lit(7)).alias("text_key"), text.alias("text"))
    every = stored(sketches(rows, size))
    # Distinct sets are the nodes: ids may repeat or be missing. One row, the leader's, stands for each.
    key = ["n", "key1", "key2"]
    leader = F.min(F.struct("doc_id", "text_key")).alias("leader")
    alone = every.filter("n > 0").groupBy(*key).agg(leader, F.first("registers").alias("registers"), F.first("bands").alias("bands"))
    nodes = stored(alone.select("*", F.monotonically_increasing_id().alias("node"), "leader.doc_id", "leader.text_key").drop("leader"))
    entries = nodes.select("node", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    members = stored(entries.join(shared, "band").select("band", "node", "hub"))
    # The whole sets of the candidates, from their texts.
    named = nodes.select("node", "doc_id", "text_key").join(members.select("node").distinct(), "node")
    texts = rows.join(named, ["doc_id", "text_key"]).dropDuplicates(["node"]).select("node", "text")
    sets = stored(full_sets(texts, size))
    best = F.max(F.struct("hits", (-F.col("hub")).alias("minus")))
    pairs = (
        members.filter("hub < node").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("hits"))
        .groupBy("node").agg(best.alias("best")).select(F.col("node").alias("a"), (-F.col("best.minus")).alias("b"))
    )
    first = stored(verified(pairs, nodes, sets, percent))
    near = stored(components(first))
    more = stored(rest(members, near, nodes, sets, percent, chunk))
    if not more.isEmpty():
        near = stored(components(more.unionByName(near.select(F.col("id").alias("a"), F.col("component").alias("b")))))

    of_node = nodes.join(near, nodes.node == near.id, "left").select(*key, "doc_id", F.coalesce("component", "node").alias("component"))
    least = of_node.groupBy("component").agg(F.min("doc_id").alias("least"))
    of_set = of_node.drop("doc_id").join(least, "component").select(*key, "least")
    known = lambda c: F.when(c != NO_ID, c)
    component = F.coalesce("least", "doc_id")
    return every.select("doc_id", *key).join(of_set, key, "left").select(
        known(F.col("doc_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        known(component).alias("component_id"),
        (F.col("doc_id") == component).alias("kept"),
    )
