"""Exact duplicates by Patricia tries over whole byte strings.

Every map task first puts its own texts into a compressed radix trie, so a hot text leaves a task
once. The distinct texts are then dealt by length and content hash, and each partition inserts the
full byte strings into its trie, whose terminal nodes keep the smallest identifier and the number
of rows. A trie that outgrows its memory budget spills whole subtrees: a map task sends them on
(a later trie merges them), a final task marks them as open, and they go through another round with
more partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import stored, tidy

WHITE = r"[\x20\x09-\x0D]+"
NODE_BYTES = 400
ENTRIES = "text binary, keep_id bigint, group_size bigint"


def normalised(text: Column) -> Column:
    """Null counts as empty; each run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


class Node:
    __slots__ = ("label", "children", "keep", "rows", "spilled")

    def __init__(self, label: bytes, keep: int | None = None, rows: int = 0):
        self.label, self.keep, self.rows = label, keep, rows
        self.children: dict[int, Node] = {}
        self.spilled = False


def shared_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differs = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differs.bit_length() + 7) // 8


class RadixTrie:
    """A compressed trie of byte strings; `size` estimates its memory."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.size = 0

    def insert(self, text: bytes, keep: int, rows: int) -> bool:
        """Add a text; False if it belongs to a subtree that was spilled."""
        node, at = self.root, 0
        while not node.spilled:
            if at == len(text):
                node.keep = keep if node.keep is None else min(node.keep, keep)
                node.rows += rows
                return True
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], keep, rows)
                self.size += NODE_BYTES + len(text) - at
                return True
            label = child.label
            if not text.startswith(label, at):
                if child.spilled:
                    # The stub stands for all texts that go through its first byte.
                    return False
                cut = shared_prefix(label, text[at : at + len(label)])
                middle = Node(label[:cut])
                child.label = label[cut:]
                middle.children[label[cut]] = child
                node.children[text[at]] = middle
                self.size += NODE_BYTES
                child, label = middle, middle.label
            at += len(label)
            node = child
        return False

    def entries(self, top: Node, prefix: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Terminal nodes under a node whose own label ends at prefix."""
        stack = [(top, prefix)]
        while stack:
            node, text = stack.pop()
            if node.rows:
                yield text, node.keep, node.rows
            stack += [(child, text + child.label) for child in node.children.values()]

    def spill(self) -> Iterator[tuple[bytes, int, int]]:
        """Take out the largest subtree under the first branching; a stub stays in its place."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and not node.rows:
            (child,) = node.children.values()
            if child.spilled:
                return
            node, prefix = child, prefix + child.label
        sizes = {}
        for byte, child in node.children.items():
            if not child.spilled:
                below = [child]
                total = 0
                while below:
                    x = below.pop()
                    total += NODE_BYTES + len(x.label)
                    below += x.children.values()
                sizes[byte] = total
        if not sizes:
            return
        byte = max(sizes, key=sizes.get)
        child = node.children[byte]
        yield from self.entries(child, prefix + child.label)
        child.children, child.keep, child.rows, child.spilled = {}, None, 0, True
        self.size -= sizes[byte] - NODE_BYTES - len(child.label)

    def unstub(self) -> None:
        """Forget all stubs, after which spilled subtrees may grow again."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            node.children = {k: c for k, c in node.children.items() if not c.spilled}
            stack += node.children.values()


@tidy
def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int]]:
    for batch in batches:
        text, keep, rows = (batch.column(i) for i in range(3))
        yield from zip(text.to_pylist(), keep.to_pylist(), rows.to_pylist(), strict=True)


def _chunks(rows: Iterable[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[0] or b"")
        if size > limit:
            yield pa.record_batch(list(zip(*held, strict=True)), schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch(list(zip(*held, strict=True)), schema=schema)


_ENTRIES = pa.schema([("text", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
_OWNERS = pa.schema([*_ENTRIES, ("digest", pa.binary())])


def combine(budget: int):
    """Map side: equal texts of a task become one row; spilled subtrees are simply sent on."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> Iterator[tuple]:
            trie = RadixTrie()
            for text, keep, rows in _rows(batches):
                trie.insert(text, keep, rows)
                while trie.size > budget:
                    before = trie.size
                    yield from trie.spill()
                    trie.unstub()
                    if trie.size >= before:
                        yield from trie.entries(trie.root, b"")
                        trie = RadixTrie()
            yield from trie.entries(trie.root, b"")

        yield from _chunks(merged(), _ENTRIES)

    return run


def owners(budget: int):
    """Final tries: a text's owner and size, or, where its subtree was spilled, the text again."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled() -> Iterator[tuple]:
            trie = RadixTrie()
            for text, keep, rows in _rows(batches):
                if not trie.insert(text, keep, rows):
                    yield text, keep, rows, None
                elif trie.size > budget:
                    yield from ((*entry, None) for entry in trie.spill())
            for text, keep, rows in trie.entries(trie.root, b""):
                yield None, keep, rows, hashlib.sha256(text).digest()

        yield from _chunks(settled(), _OWNERS)

    return run


def text_owners(entries: DataFrame, budget: int) -> DataFrame:
    """(digest, keep_id, group_size) of every distinct text of (text, keep_id, group_size) rows."""
    schema = ENTRIES + ", digest binary"
    parts, left = [], entries
    for level in range(1, 64):
        key = [F.length("text"), F.xxhash64("text", F.lit(level))]
        dealt = left.repartition(*key) if level == 1 else left.repartition(64 << min(level, 12), *key)
        result = stored(dealt.mapInArrow(owners(budget), schema))
        parts.append(result.filter("digest IS NOT NULL").select("digest", "keep_id", "group_size"))
        left = result.filter("digest IS NULL").select("text", "keep_id", "group_size")
        if left.isEmpty():
            break
    else:
        raise RuntimeError("texts were still spilled after 63 rounds; raise the budget")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def exact_dedup(docs: DataFrame, budget: int = 96 << 20) -> DataFrame:
    """Each row's group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    Reads the columns doc_id and text only, so other columns may have any name. A null text counts
    as an empty one; empty texts form a group. Rows that repeat a doc_id each get a row and each
    count in group_size; those with the owner's doc_id are all kept. A row with a null doc_id gets
    a row; it owns a group only if no other row does, and keep_id is then null. An empty table
    gives an empty result. `budget` bounds a trie's memory in bytes; it does not change the result.
    """
    rows = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    # A null id sorts last: it is kept as the largest id within the tries.
    top = (1 << 63) - 1
    entries = rows.select(
        F.col("text").cast("binary").alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(top)).alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
    ).mapInArrow(combine(budget), ENTRIES)
    found = text_owners(entries, budget).withColumn("keep_id", F.expr(f"nullif(keep_id, {top})"))
    members = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    return members.join(found, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
