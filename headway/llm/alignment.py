"""Alignment of two tokenizers over a corpus: which of their tokens cover the same bytes.

Texts are made distinct first: documents are shuffled by their full text and counted. Each distinct
text is tokenised and aligned once; what it adds to the corpus-wide counts is weighted by its number
of documents. Texts are taken in blocks of a few MB. A block is cut into units before single spaces,
where neither tokenizer can join what stands on either side, and each distinct unit is aligned once.
A block sends its distinct pairs of ids with the number of its documents that hold them, and gets the
corpus-wide counts of its own pairs back; the measures of a text are then joined to all documents
that have it.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.blocks import binary, distinct, pack, unpack
from headway.llm.shared import sliced, stored, tidy
from headway.llm.token_counts import cuts_bytes

MARK = "▁"
BATCH_BYTES = 8 << 20
SHIFT = 24  # a pair of ids is a << SHIFT | b
BLOCKS = pa.schema(
    [("block", pa.int64()), ("payload", pa.binary()), ("codes", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64()))]
)
MEASURES = pa.schema(
    [("digest", pa.binary())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)
MEASURES_DDL = "digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class Unit(NamedTuple):
    """The alignment of a unit; `sound` is False where a tokenizer does not give its bytes back."""

    sound: bool
    n_a: int
    n_b: int
    n_groups: int
    links: bytes  # pairs of ids, one for each stretch of bytes in one token of either side
    groups: bytes


UNSOUND = Unit(False, 0, 0, 0, b"", b"")


def byte_letters() -> dict[str, int]:
    """The byte of each letter that byte-level vocabularies write for it."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Aligns tokens of a byte-level .json file (a) and of a .model file (b).

    Units of up to `long` bytes that recur in a block are remembered, the latest `held` to twice as many.
    """

    def __init__(self, path_a: str, path_b: str, held: int = 100_000, long: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letter = byte_letters()
        self.bytes_a = {
            i: bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode() for t, i in self.a.get_vocab().items()
        }
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        # Units are what a text can be cut into only if no token of either side has a blank behind something else.
        parts = json.loads(self.a.to_str())
        split = parts["pre_tokenizer"] or {}
        self.cuts = (
            split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"] and parts["normalizer"] is None
            and not any(MARK in p.lstrip(MARK) for p in pieces)
        )
        last = max(self.bytes_a, default=0) + 1
        self.width_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(last)], np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.text_a, self.text_b = ([str(i).encode() for i in range(n)] for n in (last, len(self.bytes_b)))
        self.held, self.long = held, long
        self.new: dict[bytes, Unit] = {}
        self.old: dict[bytes, Unit] = {}

    def align(self, units: list[bytes], a: list[list[int]], b: list[list[int]]) -> Iterator[Unit]:
        """The alignment of each unit with these ids: ends of tokens are compared for all of them at once."""
        size_a, size_b = ([len(x) for x in side] for side in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(side), np.int64, sum(n)) for side, n in ((a, size_a), (b, size_b)))
        ends_a, ends_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        # A stretch of bytes in one token of either side is a link; common ends close groups.
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = (ids_a[at_a] << SHIFT | ids_b[at_b]).tobytes()
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        # Written group by group: a's ids, a bar, b's ids, a semicolon.
        group_a, group_b = (np.cumsum(x) - x for x in (last_a, last_b))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = [self.text_a[i] + (b"|" if x else b",") for i, x in zip(ids_a.tolist(), last_a.tolist(), strict=True)]
        written += [self.text_b[i] + (b";" if x else b",") for i, x in zip(ids_b.tolist(), last_b.tolist(), strict=True)]
        written = [written[k] for k in order.tolist()]
        edge_a, edge_b = np.cumsum([0, *size_a]), np.cumsum([0, *size_b])
        edge = np.concatenate([[0], np.cumsum([len(u) for u in units])])
        cut = np.searchsorted(ends, edge, side="right").tolist()
        groups = np.concatenate([[0], np.cumsum(last_a)])[edge_a]
        rows = zip(size_a, size_b, np.diff(groups).tolist(), cut[:-1], cut[1:], (edge_a + edge_b)[:-1].tolist(), (edge_a + edge_b)[1:].tolist(), strict=True)
        for n_a, n_b, n, p, q, r, t in rows:
            yield Unit(True, n_a, n_b, n, links[8 * p : 8 * q], b"".join(written[r:t])[:-1])

    def aligned(self, units: list[bytes]) -> list[Unit]:
        words = [u.decode("utf-8", "replace") for u in units]
        a = [x.ids for x in self.a.encode_batch_fast(words, add_special_tokens=False)]
        b = self.b.encode([w[1:] for w in words], num_threads=1)
        get_a, get_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        whole = b"".join(units)
        if b"".join(map(get_a, chain.from_iterable(a))) != whole or b"".join(map(get_b, chain.from_iterable(b))) != whole:
            good = [b"".join(map(get_a, x)) == u == b"".join(map(get_b, y)) for u, x, y in zip(units, a, b, strict=True)]
            found = self.align(*(list(compress(x, good)) for x in (units, a, b)))
            return [next(found) if x else UNSOUND for x in good]
        return list(self.align(units, a, b))

    def units(self, texts: list[bytes], often: list[int]) -> list[Unit]:
        """The alignment of each unit, which starts with the blank that is put in front."""
        found: list[Unit | None] = [self.new.get(t) or self.old.get(t) for t in texts]
        missing = [k for k, x in enumerate(found) if x is None]
        for start in range(0, len(missing), 4096):
            some = missing[start : start + 4096]
            for k, x in zip(some, self.aligned([texts[k] for k in some]), strict=True):
                found[k] = x
        for t, x, n in zip(texts, found, often, strict=True):
            if n > 1 and len(t) <= self.long:  # what occurs once is seldom met again
                if len(self.new) >= self.held:
                    self.old, self.new = self.new, {}
                self.new[t] = x
        return found

    def block(self, digests: list[bytes], texts: list[bytes], copies: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(payload, sorted pairs, documents with each pair) of distinct texts with numbers of documents."""
        lines = [b" " + t for t in texts]
        data = np.frombuffer(b"".join(lines), np.uint8)
        docs = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)
        cut = cuts_bytes(data) if self.cuts else np.empty(0, np.int64)
        edges = distinct(np.concatenate([cut[data[cut] == 0x20], docs]))
        coded = binary(data, edges).dictionary_encode()
        code, first = coded.indices.to_numpy().astype(np.int64), np.searchsorted(edges, docs)
        kinds = self.units(coded.dictionary.to_pylist(), np.bincount(code).tolist())
        add = lambda per_unit: np.diff(np.concatenate([[0], np.cumsum(per_unit[code])])[first])
        get = lambda name: np.array([getattr(k, name) for k in kinds], np.int64)
        sound = add(1 - get("sound")) == 0
        size = np.array([len(k.links) // 8 for k in kinds], np.int64)
        groups = [k.groups for k in kinds]
        hashes = [
            hashlib.sha256(b";".join([groups[u] for u in code[p:q].tolist()])).digest() if good else bytes(32)
            for p, q, good in zip(first[:-1].tolist(), first[1:].tolist(), sound.tolist(), strict=True)
        ]
        # Distinct units of each sound text, and how often they stand there.
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        used, often = np.unique((doc * len(kinds) + code)[sound[doc]], return_counts=True)
        doc, unit = used // len(kinds), used % len(kinds)
        codes, place = np.unique(np.frombuffer(b"".join([k.links for k in kinds]), np.int64), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(size)])
        many = size[unit]
        flat = place[np.repeat(at[unit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
        holds = distinct(np.repeat(doc, many) * max(1, len(codes)) + flat)
        weights = np.bincount(holds % max(1, len(codes)), copies[holds // max(1, len(codes))], len(codes)).astype(np.int64)
        counts = np.array([np.where(sound, add(x), 0) for x in (get("n_a"), get("n_b"), get("n_groups"), size)], np.int64)
        own = np.bincount(doc, minlength=len(texts))
        payload = pack(
            np.frombuffer(b"".join(digests), np.uint8), np.frombuffer(b"".join(hashes), np.uint8), counts.ravel(), sound, own,
            np.diff(unit, prepend=0).astype(np.int32), often.astype(np.int32), size.astype(np.int32), place.astype(np.int32),
        )
        return payload, codes, weights


def measures(payload: bytes, count: np.ndarray, best: np.ndarray) -> list:
    """Columns of MEASURES for a block, given its pairs' counts and whether they are the highest of their a."""
    digests, hashes, counts, sound, own, gaps, often, size, place = unpack(payload)
    n = len(sound)
    at = np.concatenate([[0], np.cumsum(size)])
    of_unit = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[place])])[at])
    unit, docs = np.cumsum(gaps, dtype=np.int64), np.concatenate([[0], np.cumsum(own)])
    of_text = lambda x: np.diff(np.concatenate([[0], np.cumsum(of_unit(x)[unit] * often)])[docs])
    cells = [x.tobytes() for x in digests.reshape(n, 32)]
    names = [x.tobytes().hex() if good else "" for x, good in zip(hashes.reshape(n, 32), sound, strict=True)]
    return [cells, *counts.reshape(4, n), of_text(best.astype(np.int64)), of_text(count), names]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker, so tasks that follow one another know the same units."""
    return Aligner(path_a, path_b)


def align(docs: DataFrame, path_a: str, path_b: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """How two tokenizers align on each row's whole text.

    doc_id, n_a and n_b (tokens), n_groups (stretches between common token ends), n_links
    (overlapping tokens a, b), n_best (links whose pair of ids is held by the most documents of all
    pairs with that a; ties count), count_sum (documents that hold a link's pair, summed over links),
    groups_sha256 of `a1,a2|b1;a3|b2,b3`. `path_a` is a byte-level .json file and gets the text
    behind a blank, `path_b` a .model file that puts the blank there itself; both are present on all
    machines. Strings of special tokens are plain text. A null or empty text, or one that a
    tokenizer does not give back byte by byte, has zeros and an empty groups_sha256, and counts
    nowhere. Rows that repeat a text, a doc_id or both, or have no doc_id, each get a row and each
    count as a document. Only doc_id and text are read; an empty table gives no row. `batch_bytes`
    bounds the texts of a block and does not change the result.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.nullif(text, F.lit("")).alias("text"))
    once = rows.filter("text IS NOT NULL").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, "text", batch_bytes):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            payload, codes, weights = own.block(batch.column("digest").to_pylist(), texts, batch.column("copies").to_numpy())
            yield pa.record_batch([[number], [payload], [codes], [weights]], schema=BLOCKS)
            number += 1

    # Stored: block numbers are those of the tasks that wrote them.
    blocks = stored(
        once.select("text", "copies", F.unhex(F.sha2("text", 256)).alias("digest"))
        .mapInArrow(run, "block bigint, payload binary, codes array<bigint>, weights array<bigint>")
    )
    pairs = blocks.select(F.col("block").alias("of"), F.explode(F.arrays_zip("codes", "weights")).alias("x")).select("of", "x.codes", "x.weights")
    counts = pairs.groupBy("codes").agg(F.sum("weights").alias("count")).withColumn("a", F.shiftright("codes", SHIFT))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    scored = counts.join(most, "a").select("codes", "count", (F.col("count") == F.col("most")).alias("best"))
    back = pairs.select("of", "codes").join(scored, "codes")

    @tidy
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["codes"].to_numpy())
        count, best = right["count"].to_numpy()[order], right["best"].to_numpy()[order]
        columns = measures(left["payload"][0].as_py(), count, best)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, MEASURES, strict=True)], schema=MEASURES)

    found = blocks.select("block", "payload").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(finish, MEASURES_DDL)
    members = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return members.join(found, "digest", "left").select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
