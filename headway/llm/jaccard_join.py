"""Documents that share enough of their word shingles, by signature trees.

1. A document can only have a partner if enough of its shingles occur in other documents
   (`blocks.holders`); all others are done. Equal sets become one.
2. Ordered from rare to frequent, two linked sets share one of their first shingles (the prefix),
   so the documents of a prefix shingle are a group. Each document goes once, with its set, to the
   group of the smallest document it meets most often, in chunks; each chunk is joined with itself
   by a signature tree. What it links is contracted to components.
3. Of each group whose documents still lie in several components, the component with most shingles
   is the hub. A document goes once, with its set, to each hub of its groups, however many of these
   have that hub, and meets the documents there that are not connected with it; overlaps are counted
   exactly, of one document with many others at a time. Large hubs are joined chunk by chunk. So every
   pair that shares a prefix shingle is either in one component or tested.

Short sets (lines) meet in their groups themselves, by trees of signatures and components.

A tree's nodes hold the OR of their sets' bitmaps, the range of their sizes, the most elements that
share a bit, and their component if it is one. A pair of nodes is left out if no pair of sizes fits,
if the common bits and the doubled ones cannot reach the overlap that is needed, or if all their
documents are already connected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.blocks import BLOCK_BYTES, NO_ID, Block, block_count, classes, holders, key_bits, mixed, packed, shortened
from headway.llm.components import components
from headway.llm.shared import grouped, stored, tidy

BITS = 1024
LEAF = 8
SIDE = 1 << 20  # shingles of a chunk of a hub
AT_ONCE = 256  # documents that one is compared with at a time
SETS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("shared", pa.binary()),
        ("signature", pa.binary()), ("prefix", pa.list_(pa.int64())),
    ]
)
SETS_DDL = "doc_id bigint, n bigint, key1 bigint, key2 bigint, shared binary, signature binary, prefix array<bigint>"
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def occurrences(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and fingerprint of each shingle, repeated ones too; a shorter text is one shingle as a whole."""
    first, value = block.windows(size)
    doc = block.doc[first]
    words = np.diff(block.first)
    few = np.flatnonzero((words > 0) & (words < size))
    whole = np.zeros(len(few), np.uint64)
    for j in range(size - 1):
        more = words[few] > j
        whole[more] = mixed(whole[more] + block.hashes[block.first[few[more]] + j])
    return np.concatenate([doc, few]), np.concatenate([value, mixed(whole ^ np.uint64(size))])


def shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and fingerprint of each distinct shingle, in order."""
    doc, value = occurrences(block, size)
    order = np.argsort(value)
    # Numbers of 16 bits are sorted by digits.
    owner = doc[order].astype(np.uint16) if len(block.ids) <= 1 << 16 else doc[order]
    order = order[np.argsort(owner, kind="stable")]
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def signature(values: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, bool)
    bits[(values >> np.uint64(20)) % np.uint64(BITS)] = True
    return np.packbits(bits)


class SignatureTree:
    """A binary tree over sets in order of component and size; node i has children in i + 1 and right[i]."""

    def __init__(self, sizes: np.ndarray, held: np.ndarray, bitmaps: np.ndarray, component: np.ndarray):
        """held: elements that the bitmaps (rows of uint64) stand for."""
        self.order = np.lexsort((sizes, component))
        sizes, held, bitmaps, component = sizes[self.order], held[self.order], bitmaps[self.order], component[self.order]
        doubled = held - np.bitwise_count(bitmaps).sum(axis=1)
        self.span, self.right, self.bits, self.low, self.high, self.doubled, self.component = [], [], [], [], [], [], []

        def build(a: int, b: int) -> int:
            me = len(self.span)
            self.span.append((a, b))
            self.right.append(0)
            self.bits.append(np.bitwise_or.reduce(bitmaps[a:b]))
            self.low.append(int(sizes[a:b].min()))
            self.high.append(int(sizes[a:b].max()))
            self.doubled.append(int(doubled[a:b].max()))
            self.component.append(int(component[a]) if component[a] == component[b - 1] else None)
            if b - a > LEAF:
                build(a, (a + b) // 2)
                self.right[me] = build((a + b) // 2, b)
            return me

        build(0, len(self.order))

    def children(self, i: int) -> tuple[int, ...]:
        return (i + 1, self.right[i]) if self.right[i] else (i,)


def dual(x: SignatureTree, y: SignatureTree, percent: int) -> Iterator[tuple[int, int]]:
    """Every pair (member of x, member of y) of leaves that may hold a link; of one tree each pair once."""
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if x is y and i > j:
            continue
        if x.component[i] is not None and x.component[i] == y.component[j]:
            continue
        if 100 * x.high[i] < percent * y.low[j] or 100 * y.high[j] < percent * x.low[i]:
            continue
        most = int(np.bitwise_count(x.bits[i] & y.bits[j]).sum()) + min(x.doubled[i], y.doubled[j])
        if (100 + percent) * most < percent * (x.low[i] + y.low[j]):
            continue
        a, b = x.children(i), y.children(j)
        if len(a) == len(b) == 1:
            left, right = (t.order[slice(*t.span[k])].tolist() for t, k in ((x, i), (y, j)))
            for p in left:
                for q in right:
                    if x is not y or i < j or p < q:
                        yield p, q
        else:
            todo += [(p, q) for p in a for q in b]


def _bitmaps(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def fingerprints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def linked_chunk(rows: list[dict], percent: int, decode: Callable[[bytes], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges that connect what links connect among the documents of a chunk."""
    sets = [decode(r["shared"]) for r in rows]
    sizes = np.array([r["n"] for r in rows])
    parent = list(range(len(rows)))
    bits = [r["signature"] if "signature" in r else signature(s).tobytes() for r, s in zip(rows, sets, strict=True)]
    tree = SignatureTree(sizes, np.array([len(s) for s in sets]), _bitmaps(bits), np.arange(len(rows)))
    for p, q in dual(tree, tree, percent):
        if _find(parent, p) != _find(parent, q):
            both = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
            if (100 + percent) * both >= percent * (sizes[p] + sizes[q]):
                parent[_find(parent, p)] = _find(parent, q)
                yield rows[p]["doc_id"], rows[q]["doc_id"]


def candidate_chunk(rows: list[dict], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of documents of two chunks (sides) that may be linked and lie in different components."""
    sides = sorted({r["side"] for r in rows})
    parts = [[r for r in rows if r["side"] == s] for s in sides]

    def doubled(row: dict) -> int:
        return row["held"] - int(np.bitwise_count(np.frombuffer(row["signature"], np.uint64)).sum())

    def tree(own: list[dict]) -> SignatureTree:
        get = lambda k: np.array([r[k] for r in own])
        return SignatureTree(get("n"), get("held"), _bitmaps([r["signature"] for r in own]), get("component"))

    if rows[0]["first"] == rows[0]["second"]:
        x = y = tree(parts[0])
        a = b = parts[0]
    elif len(parts) == 2:
        (a, b), (x, y) = parts, map(tree, parts)
    else:
        return

    for p, q in dual(x, y, percent):
        u, v = a[p], b[q]
        if u["component"] != v["component"]:
            bits = np.bitwise_count(np.frombuffer(u["signature"], np.uint64) & np.frombuffer(v["signature"], np.uint64))
            # Elements that share a bit are bounded by those of the smaller side.
            most = min(int(bits.sum()) + doubled(u), int(bits.sum()) + doubled(v))
            if (100 + percent) * most >= percent * (u["n"] + v["n"]):
                yield max(u["doc_id"], v["doc_id"]), min(u["doc_id"], v["doc_id"])


def linked_sides(rows: list[dict], percent: int, decode: Callable[[bytes], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges that connect what links connect among the documents of two chunks (sides) with their whole sets."""
    names = {r["doc_id"]: r for r in rows}
    number = {c: i for i, c in enumerate(sorted({r["component"] for r in rows}))}
    parent = list(range(len(number)))
    known = lru_cache(256)(lambda i: decode(names[i]["shared"]))
    if len(rows) <= LEAF:  # no tree for a few
        pairs = ((u["doc_id"], v["doc_id"]) for i, u in enumerate(rows) for v in rows[:i])
    else:
        for row in rows:
            row["signature"] = signature(known(row["doc_id"])).tobytes()
            row["held"] = row["n"]
        pairs = candidate_chunk(rows, percent)
    for a, b in pairs:
        left, right = (_find(parent, number[names[i]["component"]]) for i in (a, b))
        n = names[a]["n"], names[b]["n"]
        if left != right and 100 * min(n) >= percent * max(n):
            both = len(np.intersect1d(known(a), known(b), assume_unique=True))
            if (100 + percent) * both >= percent * sum(n):
                parent[left] = right
                yield max(a, b), min(a, b)


def linked_hub(rows: list[dict], percent: int, decode: Callable[[bytes], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges that connect what links connect among the documents at a hub, or between two chunks (sides) of it."""
    _, root, many = np.unique([r["component"] for r in rows], return_inverse=True, return_counts=True)
    if len(many) < 2:
        return
    # The largest component comes last, as its documents need not be compared with each other.
    order = np.lexsort((root, many[root]))
    rows, root = [rows[i] for i in order.tolist()], root[order]
    outside = len(rows) - int(many[root[-1]])
    sizes, side = (np.array([r[k] for r in rows]) for k in ("n", "side"))
    apart = rows[0]["first"] != rows[0]["second"]
    sets = [decode(r["shared"]) for r in rows]
    _, element, copies = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = copies[element] > 1
    held = np.bincount(np.repeat(np.arange(len(sets)), [len(s) for s in sets])[common], minlength=len(sets))
    element = element[common]
    first = np.concatenate([[0], np.cumsum(held)])
    marked = np.zeros(len(copies), bool)
    for i in range(outside):
        # No two sets share more than either has in common with anything here; this bounds their sizes, too.
        need = percent * (sizes[i] + sizes[i + 1 :])
        fit = (root[i + 1 :] != root[i]) & ((100 + percent) * np.minimum(held[i], held[i + 1 :]) >= need)
        if apart:
            fit &= side[i + 1 :] != side[i]
        others = np.flatnonzero(fit) + i + 1
        if not len(others):
            continue
        own = element[first[i] : first[i + 1]]
        marked[own] = True
        for at in range(0, len(others), AT_ONCE):
            near = others[at : at + AT_ONCE]
            near = near[root[near] != root[i]]
            if not len(near):
                continue
            ends = np.cumsum(held[near])
            place = np.arange(ends[-1]) + np.repeat(first[near] - ends + held[near], held[near])
            hits = np.concatenate([[0], np.cumsum(marked[element[place]])])
            both = hits[ends] - hits[ends - held[near]]
            linked = near[(100 + percent) * both >= need[near - i - 1]]
            for j in linked[np.unique(root[linked], return_index=True)[1]].tolist():
                a, b = rows[i]["doc_id"], rows[j]["doc_id"]
                yield max(a, b), min(a, b)
                root[root == root[j]] = root[i]
        marked[own] = False


def by_group(keys: list[str], work: Callable[[list[dict]], Iterator[tuple[int, int]]]):
    """Run over rows that are sorted by keys within a partition, one group at a time."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for group in grouped(batches, keys):
            if group.num_rows < 2:
                continue
            for edge in work(group.to_pylist()):
                out.append(edge)
                if len(out) >= 10_000:
                    yield pa.record_batch(list(zip(*out, strict=True)), schema=EDGES)
                    out = []
        if out:
            yield pa.record_batch(list(zip(*out, strict=True)), schema=EDGES)

    return run


def shingle_sets(docs: DataFrame, size: int, percent: int, block_bytes: int) -> DataFrame:
    """A row a document: n shingles and, if it may have a partner, its set's key and shared shingles."""
    blocks, total = block_count(docs, block_bytes)
    bits = key_bits(total // 4)
    rows = packed(docs, blocks)

    def keys_of(block: Block) -> np.ndarray:
        return occurrences(block, size)[1]

    @tidy
    def sets(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left["payload"].to_pylist(), lower=True)
        doc, value = shingles(block, size)
        keys, place = np.unique(shortened(value, bits), return_inverse=True)
        kind = classes(right)[place]
        shared = (kind > 0) | (np.bincount(place, minlength=len(keys))[place] > 1)
        cuts = np.searchsorted(doc, np.arange(len(block.ids) + 1))
        n = np.diff(cuts)
        common = np.diff(np.concatenate([[0], np.cumsum(shared)])[cuts])
        columns = [block.ids, n, *([None] * len(n) for _ in range(5))]
        for i in np.flatnonzero((n > 0) & (100 * common >= percent * n)).tolist():
            own = slice(cuts[i], cuts[i + 1])
            held = value[own][shared[own]]
            code = mixed(value[own])
            # Alone elements come first in the prefix; then the rare ones.
            prefix = int(n[i]) - -(-percent * int(n[i]) // 100) + 1 - int(n[i] - common[i])
            order = np.lexsort((held, kind[own][shared[own]]))[:prefix]
            columns[2][i] = int(code.sum().view(np.int64))
            columns[3][i] = int(np.bitwise_xor.reduce(code * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
            columns[4][i], columns[5][i] = held.tobytes(), signature(held).tobytes()
            columns[6][i] = held[order].view(np.int64)
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, SETS, strict=True)]
        return pa.Table.from_arrays(arrays, schema=SETS)

    held = holders(rows, keys_of, blocks, bits, lower=True)
    return rows.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(sets, SETS_DDL)


def _edges(rows: DataFrame, keys: list[str], work) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_group(keys, work), "a bigint, b bigint")


def links(
    found: DataFrame, percent: int, chunk: int, decode: Callable[[bytes], np.ndarray] = fingerprints,
    entries: DataFrame | None = None,
) -> DataFrame:
    """(id, component) of the linked documents among distinct sets.

    found: doc_id, n (size of the set), shared (what decode makes the sorted elements of that may
    occur elsewhere), signature, and prefix, the keys one of which linked sets have in common, unless
    `entries` has these as rows (doc_id, shingle). Short sets come without signature, with all their
    elements in shared: they go to every group that they are in, other sets once to every hub of these.
    """
    short = "signature" not in found.columns
    entries = stored(found.select("doc_id", "n", F.explode("prefix").alias("shingle")) if entries is None else entries)
    hubs = entries.groupBy("shingle").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    best = F.max(F.struct("hits", (-F.col("hub")).alias("minus")))
    home = (
        entries.join(hubs, "shingle").filter("hub < doc_id")
        .groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("hits"))
        .groupBy("doc_id").agg(best.alias("best")).select("doc_id", (-F.col("best.minus")).alias("hub"))
    )
    home = stored(home)
    size = home.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
    members = home.join(size, "hub").select("doc_id", "hub", F.pmod(F.xxhash64("doc_id"), "chunks").alias("part"))
    heads = size.select(F.col("hub").alias("doc_id"), "hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part"))
    sets = found.drop("prefix")
    chunks = members.unionByName(heads).join(sets, "doc_id")
    near = components(_edges(chunks, ["hub", "part"], lambda rows: linked_chunk(rows, percent, decode)))
    near = stored(near)

    # What the chunks could not see: groups of a prefix shingle in more than one component.
    labelled = (
        entries.join(near, entries.doc_id == near.id, "left")
        .select(*entries.columns, F.coalesce("component", "doc_id").alias("component"))
    )
    rest = stored((_met_in_groups if short else _met_at_hubs)(labelled, sets, percent, chunk, decode))
    if not rest.isEmpty():
        near = stored(components(rest.unionByName(near.select(F.col("id").alias("a"), F.col("component").alias("b")))))
    return near


def _sides(rows: DataFrame) -> DataFrame:
    """Rows with `chunks`, the number of chunks of their group, copied to all pairs of chunks that have theirs, their side."""
    return (
        rows.withColumn("side", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("chunks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .withColumn("first", F.least("side", "other")).withColumn("second", F.greatest("side", "other")).drop("chunks", "other")
    )


def _met_at_hubs(labelled: DataFrame, sets: DataFrame, percent: int, chunk: int, decode: Callable[[bytes], np.ndarray]) -> DataFrame:
    """Links between components of one prefix shingle, found at the hub of the shingle: its heaviest component."""
    hubs = (
        labelled.groupBy("shingle", "component").agg(F.sum("n").alias("weight"))
        .groupBy("shingle").agg(F.max(F.struct("weight", (-F.col("component")).alias("minus"))).alias("best"), F.count(F.lit(1)).alias("many"))
        .filter("many > 1").select("shingle", (-F.col("best.minus")).alias("hub"))
    )
    visits = stored(labelled.join(hubs, "shingle").select("hub", "doc_id", "component", "n").distinct())
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / (8 * chunk)), F.ceil(F.sum("n") / SIDE))
    size = visits.groupBy("hub").agg(parts.alias("chunks"))
    met = _sides(visits.join(size, "hub")).join(sets.select("doc_id", "shared"), "doc_id")
    return _edges(met, ["hub", "first", "second"], lambda rows: linked_hub(rows, percent, decode))


def _met_in_groups(labelled: DataFrame, sets: DataFrame, percent: int, chunk: int, decode: Callable[[bytes], np.ndarray]) -> DataFrame:
    """Links between components of one prefix shingle, found in the group of the shingle."""
    open_ = (
        labelled.groupBy("shingle")
        .agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count(F.lit(1)).alias("many"))
        .filter("p < q").select("shingle", F.ceil(F.col("many") / (8 * chunk)).alias("chunks"))
    )
    met = _sides(labelled.join(open_, "shingle")).join(sets, "doc_id")
    return _edges(met, ["shingle", "first", "second"], lambda rows: linked_sides(rows, percent, decode)).distinct()


def jaccard_join(
    docs: DataFrame, size: int = 5, percent: int = 75, block_bytes: int = BLOCK_BYTES, chunk: int = 256
) -> DataFrame:
    """Connect documents whose shingle sets have 100 * intersection >= percent * union.

    Words are runs of other bytes than 0x20 and 0x09-0x0D with A-Z in lower case; a set holds the
    distinct shingles of `size` words, or the whole sequence of fewer words. Returns a row for each
    document: doc_id, n_shingles, component_id, the smallest doc_id reachable by links. Null texts
    and texts without words have no shingle and no link. A null doc_id counts as larger than others.
    Rows that repeat a doc_id, or have none, are judged row by row and do not connect each other. Only doc_id and text are read; an empty table
    gives no row. `block_bytes` and `chunk` bound what a task holds; they do not change the result.
    Shingles are compared by 64-bit fingerprints.
    """
    every = stored(shingle_sets(docs, size, percent, block_bytes))
    alive = every.filter("key1 IS NOT NULL")
    key = ["n", "key1", "key2"]
    # Sets are the nodes: ids may repeat or be missing.
    sets = stored(alive.groupBy(*key).agg(F.min("doc_id").alias("leader")).withColumn("node", F.monotonically_increasing_id()))
    # One row of each set: the leader's, once even if its row is repeated.
    found = alive.join(sets.withColumnRenamed("leader", "doc_id"), [*key, "doc_id"]).drop("doc_id", *key[1:])
    once = stored(found.dropDuplicates(["node"]).withColumnRenamed("node", "doc_id"))
    labels = links(once, percent, chunk)
    named = sets.join(labels, sets.node == labels.id).select(*key, "leader", F.col("component").alias("linked"))
    least = named.groupBy("linked").agg(F.min("leader").alias("least"))
    alone = sets.join(labels, sets.node == labels.id, "left_anti").select(*key, F.col("leader").alias("component"))
    of_set = named.join(least, "linked").select(*key, F.col("least").alias("component")).unionByName(alone)
    known = lambda c: F.when(c != NO_ID, c)
    return every.select("doc_id", *key).join(of_set, key, "left").select(
        known(F.col("doc_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        known(F.coalesce("component", "doc_id")).alias("component_id"),
    )
