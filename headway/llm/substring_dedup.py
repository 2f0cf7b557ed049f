"""Repeated passages by prefix-partitioned suffix trees over words.

A suffix starts at each word. Only suffixes whose first `window` words seem to occur twice are laid
into trees: inside a block of documents there, and where several blocks seem to have them
(`blocks.holders`) across blocks; of equal ones a block sends one, that of its smallest document.
Groups are made by a prefix of variable length: some bytes of words at least, then longer word by
word while more suffixes begin so than a group is to hold, as a count over all texts shows
(`heavy_prefixes`). Each group sorts its suffixes, cut to `window` words, and takes the longest
common prefixes of neighbours: the intervals that share all `window` words are the deep internal
nodes of its suffix tree. A suffix goes if its node has a smaller document. Neighbouring repeats of
a document make up its maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.blocks import (
    BLOCK_BYTES, NO_ID, SPACE, Block, binary, block_count, classes, holders, key_bits, pack, packed, shortened, unpack,
)
from headway.llm.shared import sliced, tidy

PREFIX_BYTES = 16  # a prefix has this many bytes at least, blanks included
GROUP_SUFFIXES = 1 << 18  # a prefix that more suffixes share is lengthened
MOST_HEAVY = 1 << 21  # bounds the prefixes that every task is told, 16 MB
TREE_SUFFIXES = 1 << 17  # suffixes of a tree inside a block
STEP = np.uint64(0x9E3779B97F4A7C15)
BUNDLE = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
MARKS = pa.schema([("block", pa.int32()), ("payload", pa.binary())])
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
        ("kept_text", pa.string()), ("repeats", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
RESULT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, repeats array<struct<start:bigint,end:bigint>>"


def prefixes(block: Block, starts: np.ndarray, window: int, longer: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The fingerprint of each suffix's prefix: PREFIX_BYTES of words, then more while `longer` says so."""
    length = block.ends - block.starts + 1
    value, size = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    going = np.arange(len(starts))
    for j in range(window):
        at = starts[going] + j
        value[going] = value[going] * STEP + block.hashes[at]
        size[going] += length[at]
        if j + 1 == window or not len(going):
            break
        stays = size[going] < PREFIX_BYTES
        stays[~stays] = longer(value[going[~stays]])
        going = going[stays]
    return value


def prefix_groups(block: Block, starts: np.ndarray, window: int, groups: int, heavy: np.ndarray) -> np.ndarray:
    """The group of each suffix, by its shortest prefix that is not heavy."""
    value = prefixes(block, starts, window, lambda own: np.isin(own, heavy))
    return ((value ^ (value >> np.uint64(31))) % np.uint64(groups)).astype(np.int64)


def heavy_prefixes(docs: DataFrame, window: int, size: int, most: int) -> np.ndarray:
    """Fingerprints of the prefixes that about `most` suffixes or more begin with.

    A batch of texts reports a prefix if its share of suffixes is that of `most` in all `size` bytes: what has `most` in all is reported by a batch at least, and what is not found
    begins fewer than 2 * most. `most` grows where more than MOST_HEAVY prefixes could be found.
    """
    most = max(most, (window - 1) * (size // 2) // MOST_HEAVY)

    @tidy
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BLOCK_BYTES):
            texts = batch.column("text").cast(pa.large_binary())
            block = Block.of(texts)
            least = most * len(block.data) / size
            found = []

            def report(values: np.ndarray, least=least, found=found) -> np.ndarray:
                own, back, many = np.unique(values, return_inverse=True, return_counts=True)
                shown = many >= least
                found.append((own[shown], many[shown]))
                return shown[back]

            prefixes(block, block.windows(window)[0], window, report)
            for own, many in found:
                yield pa.record_batch([pa.array(own.view(np.int64)), pa.array(many.astype(np.int64))], names=["prefix", "suffixes"])

    counts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(weigh, "prefix bigint, suffixes bigint")
    heavy = counts.groupBy("prefix").agg(F.sum("suffixes").alias("suffixes")).filter(F.col("suffixes") >= most)
    return np.array([row.prefix for row in heavy.select("prefix").collect()], np.int64).view(np.uint64)


class Words:
    """The words of a block as numbers, in the order of their first bytes, which compresses well."""

    def __init__(self, block: Block):
        size = block.ends - block.starts
        text = block.data[~SPACE[block.data]]
        code = binary(text, np.concatenate([[0], np.cumsum(size)])).dictionary_encode().indices.to_numpy()
        place = np.empty(int(code.max(initial=-1)) + 1, np.int64)
        place[code[::-1]] = np.arange(len(code))[::-1]
        a, size = block.starts[place], size[place]
        head = np.zeros(len(place), np.uint64)
        for j in range(8):
            byte = block.data[np.minimum(a + j, len(block.data) - 1)].astype(np.uint64)
            head = (head << np.uint64(8)) | np.where(j < size, byte, 0)
        rank = np.argsort(head, kind="stable")
        to = np.empty(len(rank), np.int32)
        to[rank] = np.arange(len(rank))
        self.code = to[code]  # of each word
        self.place = place[rank]  # the first word of each number


class Repeats:
    """The windows of a block: classes of equal ones, each led by its first document.

    Windows whose fingerprint occurs once are alone; the others go by the deep nodes of their trees.
    Classes are in the order of their fingerprints.
    """

    def __init__(self, block: Block, window: int):
        self.first_word, value = block.windows(window)
        order = np.argsort(value, kind="stable")
        value = value[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        run = np.cumsum(new) - 1
        again = np.flatnonzero(np.bincount(run, minlength=1)[run] > 1)
        self.words = Words(block)
        node = nodes_in(self.words.code, self.first_word[order[again]], window)
        by_node = np.lexsort((node, run[again]))
        order[again] = order[again][by_node]
        node = node[by_node]
        new[again[1:]] |= node[1:] != node[:-1]
        self.of = np.empty(len(value), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.value = value[new]
        self.leader = self.first_word[order[new]]  # the first word of the leading window


def nodes_in(code: np.ndarray, starts: np.ndarray, window: int, most: int = TREE_SUFFIXES) -> np.ndarray:
    """The deep node of each suffix of a block, from trees by prefix: longer prefixes for more than `most` suffixes."""
    node = np.empty(len(starts), np.int64)
    if not len(starts):
        return node
    group = np.zeros(len(starts), np.int64)
    for j in range(window):
        open_ = np.flatnonzero(np.bincount(group)[group] > most)
        if not len(open_):
            break
        group[open_] = group.max() + 1 + group[open_] * (int(code.max()) + 1) + code[starts[open_] + j]
        group = np.unique(group, return_inverse=True)[1]
    many = np.bincount(group)
    tree_of = (np.cumsum(many) - many) // most  # small groups share a tree
    order = np.argsort(tree_of[group], kind="stable")
    edge = np.flatnonzero(np.diff(tree_of[group[order]], prepend=-1, append=-1))
    last = 0
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        own = order[a:b]
        tree = SuffixTree(code[starts[own][:, None] + np.arange(window)])
        found = tree.deep_nodes(window)
        node[own[tree.order]] = last + found
        last += int(found[-1]) + 1
    return node


def bundle(block: Block, words: Words, starts: np.ndarray, numbers: np.ndarray, window: int) -> bytes:
    """Suffixes in order, with their words: numbers, documents, a dictionary, codes by column."""
    code = words.code[starts[:, None] + np.arange(window)]
    used = np.zeros(len(words.place), bool)
    used[code] = True
    own = words.place[used]
    a, size = block.starts[own], (block.ends - block.starts)[own]
    text = block.data[np.arange(size.sum()) + np.repeat(a - np.cumsum(size) + size, size)]
    code = (np.cumsum(used) - 1)[code]
    order = np.lexsort((code[:, 2], code[:, 1], code[:, 0]))
    code = code[order].astype(np.uint16 if len(own) < 1 << 16 else np.uint32)
    return pack(
        numbers[order].astype(np.uint32), block.ids[block.doc[starts[order]]], size.astype(np.uint32), text, code.T.reshape(-1)
    )


class SuffixTree:
    """Suffixes of one prefix group in sorted order, with the common prefixes of neighbours."""

    def __init__(self, codes: np.ndarray):
        """codes: one row of word numbers a suffix."""
        width = max(1, int(codes.max(initial=0)).bit_length())
        each = max(1, 63 // width)
        keys = []
        for at in range(0, codes.shape[1], each):
            key = np.zeros(len(codes), np.int64)
            for j in range(at, min(at + each, codes.shape[1])):
                key <<= width
                key |= codes[:, j]
            keys.append(key)
        self.order = np.lexsort(keys[::-1])
        ordered = codes[self.order]
        same = np.ones((max(0, len(codes) - 1), codes.shape[1] + 1), bool)
        same[:, :-1] = ordered[1:] != ordered[:-1]
        self.common = np.argmax(same, axis=1)  # the last column stops those that are equal

    def deep_nodes(self, depth: int) -> np.ndarray:
        """For each suffix in sorted order the number of its node of that depth, leaves included."""
        return np.concatenate([[0], np.cumsum(self.common < depth)])


def substring_dedup(
    docs: DataFrame, window: int = 13, block_bytes: int = BLOCK_BYTES, with_text: bool = True, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """Take out every word in a window of words that also starts in a document with a smaller id.

    Words are the runs of other bytes than 0x20 and 0x09-0x0D, unchanged. Returns a row for each
    document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space),
    kept_text (these words, or the whole text where none goes; null unless with_text) and repeats (the maximal runs of removed words,
    as word numbers, end excluded). Windows are judged on the input. A null text has no words; a
    null doc_id counts as larger than all others; rows that repeat a doc_id are one document as to
    what is smaller, and each gets a row. Texts shorter than a window keep all words. Only doc_id
    and text are read. `block_bytes` and `group_suffixes` bound what a task holds and do not change
    the result.
    """
    blocks, size = block_count(docs, block_bytes)
    bits = key_bits(size // 4)
    groups = max(1, blocks // 3)  # a block sends a part of its suffixes only
    rows = packed(docs, blocks)
    heavy = heavy_prefixes(docs, window, size, group_suffixes) if groups > 1 else np.empty(0, np.uint64)

    def window_keys(block: Block) -> np.ndarray:
        return block.windows(window)[1]

    @tidy
    def suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        number = left["block"][0].as_py()
        block = Block(left["payload"].to_pylist())
        repeats = Repeats(block, window)
        short = shortened(repeats.value, bits)
        held = classes(right)[np.cumsum(np.diff(short, prepend=short[:1]) > 0)] if len(short) else np.empty(0, np.uint8)
        numbers = np.flatnonzero(held)
        starts = repeats.leader[numbers]
        group = prefix_groups(block, starts, window, groups, heavy)
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1)) if len(order) else np.zeros(1, int)
        found = [
            (int(group[order[a]]), number, bundle(block, repeats.words, starts[order[a:b]], numbers[order[a:b]], window))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        return pa.Table.from_batches([pa.record_batch(list(zip(*found, strict=True)), schema=BUNDLE)] if found else [], schema=BUNDLE)

    @tidy
    def subtree(table: pa.Table) -> pa.Table:
        parts = [unpack(p) for p in table["payload"].to_pylist()]
        words = pa.concat_arrays([binary(p[3], np.concatenate([[0], np.cumsum(p[2].astype(np.int64))])) for p in parts])
        word = words.dictionary_encode().indices.to_numpy()
        shift = np.concatenate([[0], np.cumsum([len(p[2]) for p in parts])])
        codes = np.concatenate(
            [word[s + p[4].astype(np.int64)].reshape(window, -1).T for p, s in zip(parts, shift[:-1], strict=True)]
        )
        doc = np.concatenate([p[1] for p in parts])
        tree = SuffixTree(codes)
        node = np.empty(len(doc), np.int64)
        node[tree.order] = tree.deep_nodes(window)
        smallest = np.full(node.max() + 1, NO_ID)
        np.minimum.at(smallest, node, doc)
        gone = smallest[node] < doc
        marks = []
        at = np.cumsum([len(p[0]) for p in parts])
        for number, p, own in zip(table["block"].to_pylist(), parts, np.split(gone, at[:-1]), strict=True):
            if own.any():
                marks.append((number, pack(p[0][own])))
        return pa.Table.from_batches([pa.record_batch(list(zip(*marks, strict=True)), schema=MARKS)] if marks else [], schema=MARKS)

    @tidy
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left["payload"].to_pylist())
        repeats = Repeats(block, window)
        elsewhere = np.zeros(len(repeats.value), bool)
        for blob in right["payload"].to_pylist():
            elsewhere[unpack(blob)[0]] = True
        id_of = lambda word: block.ids[block.doc[word]]
        gone = elsewhere[repeats.of] | (id_of(repeats.first_word) > id_of(repeats.leader)[repeats.of])
        step = np.zeros(len(block.starts) + 1, np.int64)
        np.add.at(step, repeats.first_word[gone], 1)
        np.add.at(step, repeats.first_word[gone] + window, -1)
        removed = np.cumsum(step[:-1]) > 0
        n_removed = np.diff(np.concatenate([[0], np.cumsum(removed)])[block.first])
        digests, texts, spans = [], [], []
        for i in range(len(block.ids)):
            own = block.text(i).split()
            out = removed[block.first[i] : block.first[i + 1]]
            runs = []
            if n_removed[i]:
                edge = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0))
                runs = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                own = [w for w, x in zip(own, out.tolist(), strict=True) if not x]
            kept = b" ".join(own)
            digests.append(hashlib.sha256(kept).hexdigest())
            left = kept if n_removed[i] else block.text(i)
            texts.append(left.decode("utf-8", "replace") if with_text else None)
            spans.append(runs)
        ids = pa.array(block.ids, mask=block.ids == NO_ID)
        return pa.table([ids, pa.array(np.diff(block.first)), pa.array(n_removed), pa.array(digests), pa.array(texts, pa.string()), pa.array(spans, RESULT.field("repeats").type)], schema=RESULT)

    held = holders(rows, window_keys, blocks, bits)
    bundles = (
        rows.groupBy("block").cogroup(held.groupBy("block"))
        .applyInArrow(suffixes, "part int, block int, payload binary")
    )
    marks = bundles.groupBy("part").applyInArrow(subtree, "block int, payload binary")
    return rows.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(cut, RESULT_DDL)
