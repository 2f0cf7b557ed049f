"""Blocks of whole documents, word fingerprints, and which of a block's keys other blocks have.

Documents are dealt by a hash of doc_id and length into blocks of a few MB and travel as compressed rows, so
one shuffle serves every pass over the texts. `holders` tells each block in how many blocks each of
its keys occurs: blocks send their sorted keys, shortened to a few bits more than the number of keys
needs, as delta-coded pieces by key range, and get a small class per key back. A key is sent once
by each block, so a key that all documents share costs no more than any other. Shortened keys can
only be taken as held elsewhere when they are not; what follows must check.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import sliced, tidy

NO_ID = (1 << 63) - 1  # stands for a null doc_id, after all others
BLOCK_BYTES = 8 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[SPACE] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; integers of several bytes lie in planes."""
    out = bytearray()
    for a in arrays:
        raw = a.reshape(-1).view(np.uint8).reshape(-1, a.itemsize).T
        blob = zstandard.compress(np.ascontiguousarray(raw).tobytes(), 3)
        out += f"{a.dtype.str:4}{len(blob):12d}".encode() + blob
    return bytes(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(blob):
        kind, size = np.dtype(blob[at : at + 4].decode().strip()), int(blob[at + 4 : at + 16])
        raw = np.frombuffer(zstandard.decompress(blob[at + 16 : at + 16 + size]), np.uint8)
        found.append(np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind))
        at += 16 + size
    return found


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values, axis=None)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array over a buffer of bytes."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values)]
    )


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a large_binary array."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


class Block:
    """The documents of a block by doc_id, and their words: runs without white space."""

    def __init__(self, payloads: Iterable[bytes], lower: bool = False, hashed: bool = True):
        parts = [unpack(p) for p in payloads]
        ids = np.concatenate([p[0] for p in parts])
        texts = pa.concat_arrays([binary(p[2], np.concatenate([[0], np.cumsum(p[1])])) for p in parts])
        order = np.argsort(ids, kind="stable")
        same = np.flatnonzero(ids[order][1:] == ids[order][:-1])
        if len(same):  # rows that repeat an id: in the order of their texts
            order = np.array(sorted(order.tolist(), key=lambda i: (ids[i], texts[i].as_py())))
        self.ids = ids[order]
        self._read(pa.concat_arrays([texts.take(pa.array(order))]), lower, hashed)

    @classmethod
    def of(cls, texts: pa.Array, lower: bool = False) -> Block:
        """A block of texts (large_binary) in their order, numbered from 0."""
        block = cls.__new__(cls)
        block.ids = np.arange(len(texts))
        lines = pc.binary_join_element_wise(texts, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
        block._read(pa.concat_arrays([lines]), lower, True)
        return block

    def _read(self, texts: pa.Array, lower: bool, hashed: bool) -> None:
        self.offsets, self.data = bytes_of(texts)
        # Every text ends in a line feed that was added, so no word crosses into the next one.
        space = SPACE[self.data]
        edge = np.flatnonzero(space != np.concatenate([[True], space[:-1]]))
        self.starts = edge[~space[edge]]
        self.ends = edge[space[edge]]
        self.first = np.searchsorted(self.starts, self.offsets)  # first word of each document
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.hashes = self._hashes(_LOWER[self.data] if lower else self.data) if hashed else None

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit fingerprint of each word, by pieces of about a MB."""
        found = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(self.starts):
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + (1 << 20))))
            low, high = self.starts[at], self.ends[to - 1]
            starts = self.starts[at:to] - low
            place = np.arange(high - low) - np.repeat(starts, np.diff(starts, append=high - low))
            power = np.full(int(place.max()) + 1, _STEP)
            power[0] = 1
            found[at:to] = np.add.reduceat(_TABLE[data[low:high]] * np.cumprod(power)[place], starts)
            at = to
        return mixed(found)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint of every window of so many words of one document."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        value = np.zeros(n, np.uint64)
        for j in range(size):
            value = value * _STEP + self.hashes[j : j + n]
        inside = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return inside, mixed(value[inside])

    def text(self, doc: int) -> bytes:
        return self.data[self.offsets[doc] : self.offsets[doc + 1] - 1].tobytes()


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """Number of blocks, and the bytes of all texts."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(1)), F.lit(0))).first()[0]
    return max(1, math.ceil(size / block_bytes)), size


def packed(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, payload) rows; a block's documents are spread over some of them."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 16 << 20):
            block = batch.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
            ids = batch.column("doc_id").to_numpy()
            texts = batch.column("text").cast(pa.large_binary())
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = order[a:b]
                lines = [x + b"\n" for x in texts.take(pa.array(own)).to_pylist()]
                sizes = np.array([len(x) for x in lines], np.int64)
                text = np.frombuffer(b"".join(lines), np.uint8)
                rows.append((int(block[own[0]]), pack(ids[own], sizes, text)))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "payload"])

    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # With the length, so that rows without an id, or with one and the same, do not meet.
        F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.octet_length("text")), F.lit(blocks)).cast("int").alias("block"),
    ).mapInArrow(run, "block int, payload binary")


def key_bits(keys: int) -> int:
    """Bits so that a key is taken for another one about once in 500 times."""
    return min(64, max(24, math.ceil(math.log2(max(2, keys))) + 9))


def shortened(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def _edges(ranges: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // ranges for i in range(1, ranges)], np.uint64)


def holders(
    rows: DataFrame, keys_of: Callable[[Block], np.ndarray], ranges: int, bits: int, lower: bool = False,
    hashed: bool = True, exact: bool = False,
) -> DataFrame:
    """(block, part, payload): for each block and key range the class of its sorted distinct keys.

    Class 0: no other block has the key; class c: 2 ** c blocks or more have it, up to 2 ** (c + 1).
    With `exact` the number of blocks that have the key, this one included, stands in place of its class.
    """
    ship = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])

    @tidy
    def send(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        keys = distinct(shortened(keys_of(Block(table["payload"].to_pylist(), lower, hashed)), bits))
        found = []
        for part, own in enumerate(np.split(keys, np.searchsorted(keys, _edges(ranges, bits)))):
            if len(own):
                gap = np.diff(own)
                small = gap.astype(np.uint32) if not len(gap) or gap.max() < 1 << 32 else gap
                found.append((part, block, pack(own[:1], small)))
        return pa.Table.from_batches([pa.record_batch(list(zip(*found, strict=True)), schema=ship)] if found else [], schema=ship)

    back = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())])

    @tidy
    def count(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        own = []
        for blob in table["payload"].to_pylist():
            first, gap = unpack(blob)
            own.append(np.concatenate([first, first + np.cumsum(gap.astype(np.uint64), dtype=np.uint64)]))
        keys = np.concatenate(own)
        order = np.argsort(keys)
        starts = np.flatnonzero(np.diff(keys[order], prepend=keys[order[0]] + np.uint64(1)))
        many = np.diff(starts, append=len(keys))
        kind = np.empty(len(keys), np.uint32 if exact else np.uint8)
        kind[order] = np.repeat(many.astype(np.uint32) if exact else np.log2(many).astype(np.uint8), many)
        pieces = np.split(kind, np.cumsum([len(x) for x in own])[:-1])
        return pa.table([table["block"].combine_chunks(), pa.array([part] * len(own), pa.int32()), pa.array([pack(x) for x in pieces], pa.binary())], schema=back)

    return (
        rows.groupBy("block").applyInArrow(send, "part int, block int, payload binary")
        .groupBy("part").applyInArrow(count, "block int, part int, payload binary")
    )


@tidy
def classes(table: pa.Table) -> np.ndarray:
    """The classes of a block's sorted distinct keys from the rows that `holders` has for it."""
    order = np.argsort(table["part"].to_numpy())
    blobs = table["payload"].to_pylist()
    return np.concatenate([np.empty(0, np.uint8), *(unpack(blobs[i])[0] for i in order)])
