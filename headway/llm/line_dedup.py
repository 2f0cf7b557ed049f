"""Near-duplicate lines by MinHash over character shingles.

Equal lines meet by their digest. The bands of a line's signature are keys: in each of some bins the
smallest shingle by hash counts, a few bins are a band, and an empty bin borrows from the next one.
How many depends on the size of the line's shingle set: long lines share more common shingles by
chance and get longer bands. Lines with a band that no other text has are settled at once
(`blocks.holders`). The others meet in the groups of their bands; pairs are verified by the exact
Jaccard similarity of their shingle sets, joined to components by the distributed union-find, and
each component keeps its first line.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.blocks import BLOCK_BYTES, NO_ID, Block, block_count, classes, distinct, holders, key_bits, mixed, packed, shortened
from headway.llm.jaccard_join import links
from headway.llm.shared import stored, tidy

# Part of what the result means: longer shingles would ask for a higher similarity.
SHINGLE = 5
# Least size of a set, bins a band, bands, and the hashes that the bins are dealt to; 0: a hash a bin.
# A pair of similarity 0.75 meets with a chance of 0.998; of other lines each meets few.
BANDS = ((0, 5, 26, 0), (64, 6, 40, 3), (200, 7, 48, 2), (486, 8, 72, 1))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint32(0xFFFFFFFF)
LINES = pa.schema(
    [
        ("block", pa.int32()), ("number", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int64()), ("digest", pa.binary()),
        ("shared", pa.binary()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())),
    ]
)
LINES_DDL = "block int, number bigint, doc_id bigint, line bigint, digest binary, shared binary, n bigint, prefix array<bigint>"
RESULT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of so many code points."""
    value = np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for j in range(size if len(value) else 0):
        value = value * _STEP + codes[j : j + len(value)]
    return mixed(value)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted hashes of a line's distinct shingles; a shorter line is one shingle."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    size = min(SHINGLE, max(1, len(codes)))
    return distinct(rolled(codes, size))


def short_hashes(codes: np.ndarray) -> np.ndarray:
    """A 32-bit hash of every run of SHINGLE code points, for signatures."""
    if len(codes) < SHINGLE:
        return np.zeros(1, np.uint32)
    step = np.uint32(0x9E3779B1)
    value = np.zeros(len(codes) - SHINGLE + 1, np.uint32)
    for j in range(SHINGLE):
        value *= step
        value += codes[j : j + len(value)]
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x85EBCA6B)
    return value ^ (value >> np.uint32(13))


def rehashed(value: np.ndarray, seed: int) -> np.ndarray:
    """Another 32-bit hash of each hash; different ones stay different."""
    value = (value ^ np.uint32(zlib.crc32(b"%d" % seed))) * np.uint32(0x85EBCA6B)
    value ^= value >> np.uint32(13)
    value *= np.uint32(0xC2B2AE35)
    value ^= value >> np.uint32(16)
    return value


def own_bins(line: np.ndarray, value: np.ndarray, count: int, bins: int) -> np.ndarray:
    """The smallest of each line's sorted hashes in each bin, with the distance it was borrowed over: lines x bins."""
    slot = line * bins + (value.astype(np.int64) * bins >> 32)
    new = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    slot = slot[new]
    found = np.zeros(count * bins, np.uint64)
    found[slot] = value[new]
    # An empty bin borrows from the next one that is not, round the line's own bins.
    after = np.repeat(slot, np.diff(slot, prepend=-1))
    after = np.concatenate([after, np.full(len(found) - len(after), len(found))]).reshape(count, bins)
    end = np.arange(1, count + 1)[:, None] * bins
    first = slot[np.searchsorted(slot, end - bins)]
    after = np.where(after < end, after, first)
    far = (after - np.arange(len(found)).reshape(count, bins)) % bins
    return found[after] | far.astype(np.uint64) << np.uint64(32)


def band_keys(line: np.ndarray, value: np.ndarray, starts: np.ndarray, kind: int) -> np.ndarray:
    """The band keys of lines with distinct sorted shingle hashes, those of a line from its start on: lines x bands."""
    _, rows, bands, hashes = BANDS[kind]
    key = np.broadcast_to(mixed(np.arange(bands, dtype=np.uint64) * _STEP + np.uint64(kind + 1)), (len(starts), bands)).copy()
    for part in range(hashes or rows):
        if hashes:
            # The bins of a band lie far apart, so that they do not borrow from each other.
            if part:
                code = np.sort(line.astype(np.uint64) << np.uint64(32) | rehashed(value, part))
            count = len(range(part, rows, hashes))
            own = own_bins(line, code.astype(np.uint32) if part else value, len(starts), count * bands).reshape(len(starts), count, bands)
        else:
            own = np.stack([np.minimum.reduceat(rehashed(value, part * bands + b), starts) for b in range(bands)], axis=1)
            own = own.astype(np.uint64).reshape(len(starts), 1, bands)
        for r in range(own.shape[1]):
            key = mixed(key * _STEP + own[:, r])
    return key


class Lines:
    """The lines of a block without white space around them; empty ones are not listed."""

    def __init__(self, block: Block):
        data = block.data
        stop = np.flatnonzero(data == 0x0A)
        start = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
        # Lines begin and end where their first and last words do.
        first = np.searchsorted(block.starts, start)
        after = np.searchsorted(block.starts, stop)
        some = after > first
        self.all_doc = np.searchsorted(block.offsets, start, side="right") - 1
        self.all_start, self.all_stop = start, stop
        self.place = np.flatnonzero(some)  # among all lines
        self.start, self.stop = block.starts[first[some]], block.ends[after[some] - 1]
        self.doc = self.all_doc[some]
        self.line = self.place - np.searchsorted(self.all_doc, self.doc)  # number within the document
        self.data = data

    def once(self) -> dict[bytes, list[int]]:
        """Each text's first line and how many lines have it."""
        found: dict[bytes, list[int]] = {}
        for i in range(len(self.start)):
            found.setdefault(self.text(i), [i, 0])[1] += 1
        return found

    def keys(self, own: np.ndarray, percent: int = 75) -> tuple[np.ndarray, np.ndarray]:
        """(place in own, band key) of the lines in own, by place."""
        # Code points begin at other bytes than these; a line's shingles lie within it.
        inner = np.flatnonzero((self.data & 0xC0) == 0x80)
        codes = np.frombuffer(self.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
        a, stop = (x[own] - np.searchsorted(inner, x[own]) for x in (self.start, self.stop))
        size = stop - a
        grams = np.maximum(size - SHINGLE + 1, 1)
        value = short_hashes(codes)
        ends = np.cumsum(grams)
        places, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        low = 0
        while low < len(own):  # by pieces of about 1M shingles
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - grams[low] + (1 << 20))))
            many = grams[low:high]
            first = np.cumsum(many) - many
            v = value[np.minimum(np.arange(many.sum()) + np.repeat(a[low:high] - first, many), len(value) - 1)]
            short = np.flatnonzero(size[low:high] < SHINGLE)
            if len(short):
                v[first[short]] = [zlib.crc32(self.text(i)) for i in own[low + short].tolist()]
            code = np.sort(np.repeat(np.arange(high - low, dtype=np.uint64), many) << np.uint64(32) | v)
            code = code[np.concatenate([[True], code[1:] != code[:-1]])]
            line = (code >> np.uint64(32)).astype(np.int64)
            n = np.bincount(line, minlength=high - low)
            for kind, (least, _, bands, _) in enumerate(BANDS):
                # Two linked lines are of the smaller one's kind; the larger one may be a little beyond it.
                most = BANDS[kind + 1][0] * 100 // percent + 8 if kind + 1 < len(BANDS) else n.max()
                of = (n >= least) & (n <= most)
                if of.any():
                    sizes = n[of]
                    inside = of[line]
                    starts = np.cumsum(sizes) - sizes
                    keys.append(band_keys(np.repeat(np.arange(len(sizes)), sizes), code[inside].astype(np.uint32), starts, kind).reshape(-1))
                    places.append(np.repeat(np.flatnonzero(of) + low, bands))
            low = high
        place, key = np.concatenate(places), np.concatenate(keys)
        order = np.argsort(place, kind="stable")
        return place[order], key[order]

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.stop[i]].tobytes()


def digest_of(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def line_dedup(
    docs: DataFrame, percent: int = 75, block_bytes: int = BLOCK_BYTES, chunk: int = 256, with_text: bool = True
) -> DataFrame:
    """Of each component of similar lines keep the first, by doc_id and line number.

    Lines end at line feeds; white space around a line does not count, and blank lines always stay.
    Two lines are linked if the Jaccard similarity of their sets of 5-character shingles is at least
    percent / 100; bands find such a pair with a chance of 0.998 or more (for percent >= 75). Returns a row for each
    document: doc_id, n_lines, n_removed, kept_sha256 of the kept lines joined by line feeds, and
    kept_text (null unless with_text). A null text counts as empty: one blank line. A null
    doc_id comes after all others; rows that repeat a doc_id keep or lose a line alike. Only doc_id
    and text are read. `block_bytes` and `chunk` bound what a task holds.
    """
    blocks, size = block_count(docs, block_bytes)
    bits = key_bits(size)
    rows = packed(docs, blocks)

    def keys_in(lines: Lines) -> tuple[dict[bytes, list[int]], list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """The distinct texts, their digests, both halves of these as keys, and (place, band key) of the texts."""
        once = lines.once()
        digests = [digest_of(text) for text in once]
        place, key = lines.keys(np.array([i for i, _ in once.values()], np.int64), percent)
        return once, digests, np.frombuffer(b"".join(digests), np.uint64), place, key

    def keys_of(block: Block) -> np.ndarray:
        _, _, halves, _, key = keys_in(Lines(block))
        return np.concatenate([halves, key])

    @tidy
    def similar(left: pa.Table, right: pa.Table) -> pa.Table:
        number = left["block"][0].as_py()
        lines = Lines(block := Block(left["payload"].to_pylist(), hashed=False))
        once, digests, halves, place, key = keys_in(lines)
        short, at, many = np.unique(shortened(np.concatenate([halves, key]), bits), return_inverse=True, return_counts=True)
        in_blocks = classes(right)
        # Blocks that have the text: by both halves, as one may be taken for another key.
        of_text = in_blocks[at[: len(halves)]].reshape(-1, 2).min(axis=1) if once else np.empty(0, np.int64)
        # Another text has the band here, or in a block without this text. Blocks with this text all have its bands.
        own = at[len(halves) :]
        shared = (many[own] > 1) | (in_blocks[own] > of_text[place])
        place, key = place[shared], key[shared].view(np.int64)
        cuts = np.searchsorted(place, np.arange(len(once) + 1)).tolist()
        found = []
        for j, (text, (i, copies)) in enumerate(once.items()):
            prefix = key[cuts[j] : cuts[j + 1]]
            if len(prefix):
                alike = text, len(shingle_set(text)), prefix
            elif copies > 1 or of_text[j] > 1:
                alike = None, None, None
            else:
                continue
            found.append((number, i, int(block.ids[lines.doc[i]]), int(lines.line[i]), digests[j], *alike))
        return pa.Table.from_batches([pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), LINES, strict=True)], schema=LINES)] if found else [], schema=LINES)

    @tidy
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        lines = Lines(block := Block(left["payload"].to_pylist(), hashed=False))
        # Every line of a text in question goes, unless it is the one that its component keeps.
        keeper = {lines.text(i): (d, n) for i, d, n in zip(*(right[c].to_pylist() for c in ("number", "keep_doc", "keep_line")), strict=True)}
        gone = np.zeros(len(lines.all_stop), bool)
        if keeper:
            sizes = {len(t) for t in keeper}
            for i in np.flatnonzero(np.isin(lines.stop - lines.start, list(sizes))).tolist():
                kept = keeper.get(lines.text(i))
                if kept is not None and kept != (block.ids[lines.doc[i]], lines.line[i]):
                    gone[lines.place[i]] = True
        bounds = np.searchsorted(lines.all_doc, np.arange(len(block.ids) + 1)).tolist()
        columns: list[list] = [[], [], [], []]
        for d in range(len(block.ids)):
            whole = block.text(d)
            own = gone[bounds[d] : bounds[d + 1]]
            text = b"\n".join(x for x, out in zip(whole.split(b"\n"), own.tolist(), strict=True) if not out) if own.any() else whole
            for column, value in zip(columns, (len(own), int(own.sum()), hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace") if with_text else None), strict=True):
                column.append(value)
        ids = pa.array(block.ids, mask=block.ids == NO_ID)
        return pa.table([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(RESULT)[1:], strict=True))], schema=RESULT)

    held = holders(rows, keys_of, blocks, bits, hashed=False, exact=True)
    found = stored(rows.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(similar, LINES_DDL))
    first = F.min(F.struct("doc_id", "line")).alias("first")
    same = [F.any_value(c, F.lit(True)).alias(c) for c in ("shared", "n")]
    once = stored(found.groupBy("digest").agg(first, *same).withColumn("doc_id", F.monotonically_increasing_id()))
    alike = once.filter("shared IS NOT NULL")
    # A block knows the bands that its own lines share, so those of a text differ between blocks.
    bands = found.select("digest", F.explode("prefix").alias("shingle")).distinct().join(alike.select("digest", "doc_id"), "digest")
    labels = links(alike.select("doc_id", "n", "shared"), percent, chunk, shingle_set, bands.select("doc_id", "shingle"))
    named = once.select("digest", "first", "doc_id").join(labels, F.col("doc_id") == F.col("id"), "left").select(
        "digest", "first", F.coalesce("component", "doc_id").alias("component")
    )
    keeper = named.join(named.groupBy("component").agg(F.min("first").alias("keep")), "component")
    back = found.select("block", "number", "digest").join(keeper, "digest").select(
        "block", "number", F.col("keep.doc_id").alias("keep_doc"), F.col("keep.line").alias("keep_line")
    )
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        cut, "doc_id bigint, n_lines bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )
