"""SentencePiece encoding and decoding: the N best segmentations of a text.

A text is a lattice: an edge for each vocabulary piece at each place, and for a character that no
piece covers its bytes. A forward Viterbi pass gives the best score up to each place; these scores
are an exact heuristic for an A* search backwards from the end, which therefore takes segmentations
in order of their scores. Every path passes a place between two characters that no piece has next to
each other. Between such places the lattices are independent: each distinct part, usually a word, is
searched once, and the parts' N best are merged to those of the text.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import insort
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.blocks import binary, distinct
from headway.llm.shared import sliced, tidy

MARK = "▁"
BATCH_BYTES = 8 << 20
# A byte costs more than any piece, so bytes stand only where nothing else does.
BYTE_SCORE = -1e6
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("scores", pa.list_(pa.float64())), ("ids_sha256", pa.string()),
        ("round_trip", pa.bool_()),
    ]
)


class Vocabulary:
    """The pieces of a model file and their scores."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = model.normalize
        n = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.byte: dict[int, int] = {}
        self.score: dict[str, tuple[float, tuple[int, ...]]] = {}
        for i, piece in enumerate(self.piece):
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.score[piece] = (model.get_score(i), (i,))
        self.unknown = model.unk_id()
        # Beginnings of pieces, with the score and id of those that are pieces.
        self.prefix: dict[str, tuple[float, tuple[int, ...]] | None] = {p[:i]: None for p in self.score for i in range(1, len(p))}
        self.prefix.update(self.score)
        # Characters of longer pieces by number, and which stand next to each other in one.
        pairs = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        chars = sorted({c for pair in pairs for c in pair})
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.together = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            self.together[self.number[ord(a)], self.number[ord(b)]] = True
        self.value = {i: bytes([b]) for b, i in self.byte.items()}
        self.special = {i for i in range(n) if model.is_control(i)}

    def nbest(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a normalised text, best first; equal scores by their ids.

        Where no piece is a single character, its bytes stand for it.
        """
        size = len(text)
        get = self.prefix.get
        into: list[list[tuple[int, tuple[float, tuple[int, ...]]]]] = [[] for _ in range(size + 1)]
        best = [0.0] + [-np.inf] * size
        for at in range(size):
            here, single, end = best[at], False, at + 1
            while end <= size:
                known = get(text[at:end], 0)
                if known:
                    into[end].append((at, known))
                    if here + known[0] > best[end]:
                        best[end] = here + known[0]
                    if end == at + 1:
                        single = True
                elif known == 0:  # no piece goes on like this
                    break
                end += 1
            if not single:
                ids = tuple(self.byte.get(b, self.unknown) for b in text[at].encode("utf-8", "replace"))
                into[at + 1].append((at, (BYTE_SCORE * len(ids), ids)))
                best[at + 1] = max(best[at + 1], here + BYTE_SCORE * len(ids))
        # A state is a path from some place to the end; best[place] is exactly what it lacks, so a
        # state stands for one path of its score at least, and those in the queue share no path. What
        # is worse than n of them is left out. Of equal states those nearer to the end come first, so
        # all equal ones of a place are known when its first is taken; they are taken by the ids of
        # their first piece, then in the order of what follows it: that is by their ids. No place is
        # in more than n of the n best paths' different rests, so it is taken n times at most.
        queue = [(-best[size], -size, (), 0, 0.0, None)]
        top = [-best[size]]
        taken = [0] * (size + 1)
        number = 0
        done: list[tuple[float, tuple[int, ...]]] = []
        pop, push = heapq.heappop, heapq.heappush
        while queue and len(done) < n:
            minus, at, _, _, behind, path = pop(queue)
            at = -at
            if taken[at] == n:
                continue
            taken[at] += 1
            if at == 0:
                ids: list[int] = []
                while path:
                    own, path = path
                    ids += own
                done.append((behind, tuple(ids)))
                continue
            number += 1
            same = False  # one child has its parent's score, which is in top already
            for start, (score, own) in into[at]:
                score += behind
                f = -(best[start] + score)
                if f == minus and not same:
                    same = True
                elif len(top) < n:
                    insort(top, f)
                elif f < top[-1]:
                    insort(top, f)
                    top.pop()
                elif f > top[-1]:
                    continue
                push(queue, (f, -start, own, number, score, (own, path)))
        return sorted(done, key=lambda x: (-x[0], x[1]))

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """The places between code points that every path passes."""
        number = self.number[codes]
        return np.flatnonzero(~self.together[number[:-1], number[1:]]) + 1

    def bytes_of(self, ids: Iterable[int]) -> bytes:
        return b"".join(
            self.value[i] if i in self.value else self.piece[i].replace(MARK, " ").encode() for i in ids if i not in self.special
        )

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; the blank that encoding puts in front is taken off."""
        text = self.bytes_of(ids).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def merged(own: list[tuple[float, ...]], n: int) -> list[tuple[float, dict[int, int]]]:
    """The n best choices of an alternative of each part, given the scores of its own n best.

    Returns (score, {part: alternative} for parts that do not take their best). Only the n - 1 parts
    that lose least by their second alternative can differ from the best.
    """
    losing = heapq.nsmallest(n - 1, ((p[0] - p[1], i) for i, p in enumerate(own) if len(p) > 1))
    states: list[tuple[float, dict[int, int]]] = [(0.0, {})]
    for _, i in losing:
        longer = (
            (loss + own[i][0] - s, {**choice, i: k} if k else choice) for loss, choice in states for k, s in enumerate(own[i])
        )
        states = heapq.nsmallest(n, longer, key=lambda s: (s[0], sorted(s[1].items())))
    score = sum(p[0] for p in own)
    return [(score - loss, choice) for loss, choice in states]


class Found(NamedTuple):
    """What is kept of a part: its n best scores, the number and bytes of its best ids, round trip."""

    scores: tuple[float, ...]
    count: int
    ids: bytes
    whole: bool


class Encoder:
    """N-best encoding that remembers parts: the latest ones, between `held` and twice as many."""

    def __init__(self, path: str, n: int, held: int = 350_000):
        self.words, self.n, self.held = Vocabulary(path), n, held
        self.new: dict[bytes, Found] = {}
        self.old: dict[bytes, Found] = {}

    def parts(self, text: str) -> list[str]:
        normal = self.words.normalize(text)
        codes = np.frombuffer(normal.encode("utf-32-le", "surrogatepass"), np.uint32)
        edges = [0, *self.words.cuts(codes).tolist(), len(normal)] if normal else []
        return [normal[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)] if edges else []

    def encode(self, text: str) -> list[tuple[float, list[int]]]:
        """The n best (score, ids) of a text, best first."""
        own = [self.words.nbest(p, self.n) for p in self.parts(text)]
        return [
            (score, [i for k, p in enumerate(own) for i in p[choice.get(k, 0)][1]])
            for score, choice in merged([tuple(s for s, _ in p) for p in own], self.n)
        ]

    def find(self, part: bytes) -> Found:
        found = self.new.get(part)
        if found is None:
            found = self.old.get(part)
            if found is None:
                text = part.decode("utf-8", "replace")
                best = self.words.nbest(text, self.n)
                ids = best[0][1]
                whole = text == "".join([self.words.piece[i] for i in ids])
                if not whole:  # bytes, which only decoding puts together
                    whole = text.replace(MARK, " ") == self.words.bytes_of(ids).decode("utf-8", "replace")
                found = Found(tuple(s for s, _ in best), len(ids), np.array(ids, "<i4").tobytes(), whole)
            if len(self.new) >= self.held:
                self.old, self.new = self.new, {}
            self.new[part] = found
        return found

    def batch(self, texts: list[str]) -> Iterator[tuple[int, list[float], bytes, bool]]:
        """(pieces, n best scores, bytes of the best ids, round trip) of each text."""
        normal = [self.words.normalize(t) for t in texts]
        size = np.fromiter(map(len, normal), np.int64, len(normal))
        whole = "".join(normal)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        docs = np.concatenate([[0], np.cumsum(size)])
        places = distinct(np.concatenate([self.words.cuts(codes), docs]))
        # From characters to bytes.
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
        coded = binary(data, at[places]).dictionary_encode()
        kinds = [self.find(p) for p in coded.dictionary.to_pylist()]
        code = coded.indices.to_numpy()
        count = np.array([k.count for k in kinds], np.int64)[code] if kinds else np.empty(0, np.int64)
        top = np.array([k.scores[0] for k in kinds])[code] if kinds else np.empty(0)
        loss = np.array([k.scores[0] - k.scores[1] if len(k.scores) > 1 else np.inf for k in kinds])[code] if kinds else np.empty(0)
        whole_parts = np.array([k.whole for k in kinds], bool)[code] if kinds else np.empty(0, bool)
        cut = np.searchsorted(places, docs)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            own = code[a:b]
            few = np.argpartition(loss[a:b], self.n - 2)[: self.n - 1] if b - a >= self.n else np.arange(b - a)
            scores = merged([kinds[k].scores for k in own[few].tolist()], self.n)
            rest = float(top[a:b].sum() - top[a:b][few].sum())
            ids = b"".join([kinds[k].ids for k in own.tolist()])
            yield int(count[a:b].sum()), [s + rest for s, _ in scores], ids, bool(whole_parts[a:b].all())


@lru_cache(maxsize=2)
def encoder(path: str, n: int) -> Encoder:
    """One for each worker, so tasks that follow one another know the same parts."""
    return Encoder(path, n)


def piece_counts(docs: DataFrame, path: str, n: int = 3) -> DataFrame:
    """The n best segmentations of each row's whole text.

    doc_id; n_pieces of the best; scores, best first (fewer if there are fewer); ids_sha256, of the
    best ids as 32-bit little-endian numbers; round_trip, whether decoding gives the normalised text
    again. Scores are the model file's, added up; a byte counts BYTE_SCORE. Null counts as empty: no
    piece and one empty segmentation with score 0. Repeated rows each give a row. Of segmentations
    with equal scores those with smaller ids come first. Long runs without a place to cut take time in
    proportion to their length. Only doc_id and
    text are read. `path` is a .model file that is present on all machines. Nothing is shuffled.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, n)
        for batch in sliced(batches, "text", BATCH_BYTES):
            found = own.batch([t or "" for t in batch.column("text").to_pylist()])
            rows = [
                (doc, count, scores, hashlib.sha256(ids).hexdigest(), whole)
                for doc, (count, scores, ids, whole) in zip(batch.column("doc_id").to_pylist(), found, strict=True)
            ]
            yield pa.record_batch(list(zip(*rows, strict=True)), schema=RESULT)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_pieces bigint, scores array<double>, ids_sha256 string, round_trip boolean")


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """doc_id and text of rows with an array of ids; null ids give a null text."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, 1).words
        for batch in batches:
            texts = [None if x is None else words.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    plain = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return plain.mapInArrow(run, "doc_id bigint, text string")
