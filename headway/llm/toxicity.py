"""Toxicity: gradient-boosted trees over dense features of whole texts.

Features: densities and weights of two learned lexicons (words, and stems of four or five letters),
how near their words stand to a second-person pronoun, and the rates of capitals, punctuation and
obfuscated spellings. The lexicons and trees are learned from a bounded sample of labelled rows;
raw scores are calibrated by isotonic regression on a part of it that the trees do not see.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.language_id import held_out, sampled
from headway.llm.shared import sliced, stored, tidy

BATCH_BYTES = 8 << 20
# Second-person pronouns of some languages.
SECOND_PERSON = """you your yours yourself yourselves u ur du dich dir dein deine deiner deinem deinen ihr euch euer
tu te toi ton ta tes vous votre vos ti tuyo usted ustedes vosotros os vuestro vuestra""".split()
# Characters that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…–—¡¿"
NEAR = 5
FEATURES = 16


@dataclass
class Words:
    """The words of a batch: codes into distinct words, and the document of each."""

    codes: np.ndarray
    doc: np.ndarray
    raw: pa.Array
    plain: pa.Array  # lower case, without punctuation around it
    size: np.ndarray  # bytes of each text


def split(texts: pa.Array) -> Words:
    texts = texts.cast(pa.large_string()).fill_null("")
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(words), 0)
    words, doc = words.filter(some), doc[some.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    raw = coded.dictionary
    return Words(coded.indices.to_numpy(), doc, raw, pc.utf8_trim(pc.utf8_lower(raw), EDGES), size)


def stems(plain: pa.Array, size: int) -> pa.Array:
    """The first letters of longer words; null for others."""
    long = pc.greater(pc.utf8_length(plain), size)
    return pc.if_else(long, pc.utf8_slice_codeunits(plain, 0, size), pa.scalar(None, plain.type))


def unmasked(raw: pa.Array) -> pa.Array:
    """Words with look-alikes put back and inner punctuation taken out."""
    plain = pc.utf8_lower(raw)
    for mark, letter in LEET.items():
        plain = pc.replace_substring(plain, mark, letter)
    return pc.replace_substring_regex(plain, r"[^\pL]+", "")


@dataclass
class Lexicon:
    """Weights (log odds) of words and of stems."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def _weights(table: dict[str, float], keys: pa.Array) -> np.ndarray:
        if not table:
            return np.zeros(len(keys))
        place = pc.index_in(keys, value_set=pa.array(list(table), keys.type))
        values = np.array([*table.values(), 0.0])
        return values[place.fill_null(len(table)).to_numpy(zero_copy_only=False)]

    def of_words(self, plain: pa.Array) -> np.ndarray:
        return self._weights(self.words, plain)

    def of_stems(self, plain: pa.Array) -> np.ndarray:
        return np.maximum(*(self._weights(self.stems, stems(plain, n)) for n in (4, 5)))


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    n = len(texts)
    w = split(texts)
    codes, doc = w.codes, w.doc
    total = np.bincount(doc, minlength=n)
    per = lambda x: np.bincount(doc, weights=x[codes], minlength=n)  # noqa: E731  sums over a document
    to = lambda a: a.to_numpy(zero_copy_only=False).astype(float)
    word, stem = lexicon.of_words(w.plain), lexicon.of_stems(w.plain)
    odd = to(pc.match_substring_regex(w.raw, r"\pL[0-9@$!*#%_]+\pL|(\pL[.\-])+\pL[.\-]"))
    masked = np.zeros(len(w.raw))
    strange = np.flatnonzero(odd)
    if len(strange):
        clear = unmasked(w.raw.take(pa.array(strange)))
        masked[strange] = lexicon.of_words(clear)
    length = to(pc.utf8_length(w.raw))
    capitals = to(pc.count_substring_regex(w.raw, r"\p{Lu}"))
    shouted = to(pc.match_substring_regex(w.raw, r"^\p{Lu}{3,}\PL*$"))
    marks = to(pc.count_substring_regex(w.raw, r"[^\pL\pN]"))
    exclaim = to(pc.count_substring(w.raw, "!"))
    second = to(pc.is_in(w.plain, value_set=pa.array(SECOND_PERSON, w.plain.type)))
    hit = np.flatnonzero(((word > 0) | (stem > 0) | (masked > 0))[codes])
    you = np.flatnonzero(second[codes] > 0)
    near = np.zeros(n)
    if len(hit) and len(you):
        place = np.searchsorted(you, hit)
        for other in (np.maximum(place - 1, 0), np.minimum(place, len(you) - 1)):
            close = (np.abs(you[other] - hit) <= NEAR) & (doc[you[other]] == doc[hit])
            near = np.maximum(near, np.bincount(doc[hit[close]], minlength=n))
    strongest = np.zeros(n)
    np.maximum.at(strongest, doc[hit], np.maximum(np.maximum(word, stem), masked)[codes[hit]])
    words, chars = np.maximum(total, 1), np.maximum(per(length), 1)
    flags = [per((x > 0).astype(float)) for x in (word, stem, masked)]
    columns = [
        np.log1p(total), flags[0] / words, flags[1] / words, np.log1p(flags[0]), np.log1p(flags[1]), per(word) / words,
        per(stem) / words, strongest, near / words, np.log1p(near), per(capitals) / chars, per(shouted) / words,
        per(marks) / chars, per(exclaim) / chars, per(odd) / words, np.log1p(flags[2]),
    ]
    return np.column_stack(columns).astype(np.float32)


class Trees:
    """Boosted regression trees for the log loss, on quantile bins, by second-order gains."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48):
        quantiles = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0)
        self.cuts = [np.unique(quantiles[:, j]) for j in range(x.shape[1])]
        # Rare features need a cut above their usual value.
        self.cuts = [np.unique(np.r_[c, x[:, j].min()]) for j, c in enumerate(self.cuts)]
        self.base = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        self.trees: list[list[tuple]] = []
        binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)])
        score = np.full(len(y), self.base)
        width = max(len(c) for c in self.cuts) + 1
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            tree: list[tuple] = []

            def grow(rows: np.ndarray, level: int) -> int:
                me = len(tree)
                g, h = grad[rows].sum(), hess[rows].sum()
                tree.append((-1, 0, 0, 0, rate * g / (h + 1.0)))
                best = (1e-3, None)
                if level < depth and len(rows) >= 20:
                    for j in range(binned.shape[1]):
                        own = binned[rows, j]
                        gl = np.cumsum(np.bincount(own, weights=grad[rows], minlength=width))[:-1]
                        hl = np.cumsum(np.bincount(own, weights=hess[rows], minlength=width))[:-1]
                        count = np.cumsum(np.bincount(own, minlength=width))[:-1]
                        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                        gain[(count < 5) | (len(rows) - count < 5)] = -1
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], (j, k))
                if best[1]:
                    j, k = best[1]
                    left = binned[rows, j] <= k
                    a = grow(rows[left], level + 1)
                    b = grow(rows[~left], level + 1)
                    tree[me] = (j, float(self.cuts[j][k]), a, b, 0.0)
                return me

            grow(np.arange(len(y)), 0)
            self.trees.append(tree)
            score += self._one(tree, x)

    @staticmethod
    def _one(tree: list[tuple], x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            j, cut, a, b, value = tree[at]
            if j < 0:
                out[rows] = value
            elif len(rows):
                left = x[rows, j] <= np.float32(cut)
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum(self._one(t, x) for t in self.trees)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the best non-decreasing fit, by pooling neighbours that are out of order."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum, count, lowest, highest raw score
    for r, t in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        if pools and pools[-1][3] == r:
            pools[-1][0] += t
            pools[-1][1] += 1
        else:
            pools.append([t, 1, r, r])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    x = [v for p in pools for v in (p[2], p[3])]
    return np.array(x), np.array([p[0] / p[1] for p in pools for _ in range(2)])


@dataclass
class Model:
    lexicon: Lexicon = field(default_factory=Lexicon)
    trees: Trees | None = None
    points: tuple[np.ndarray, np.ndarray] | None = None
    base: float = 0.0

    def predict(self, texts: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.base)
        raw = self.trees.score(features(texts, self.lexicon))
        return np.interp(raw, *self.points) if self.points else 1 / (1 + np.exp(-raw))


@tidy
def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, token, toxic documents, documents) of each batch."""
    for batch in sliced(batches, "text", BATCH_BYTES):
        w = split(batch.column("text"))
        toxic = batch.column("toxic").to_numpy()
        for kind, keys in (("w", w.plain), ("s", stems(w.plain, 4)), ("s", stems(w.plain, 5))):
            coded = keys.dictionary_encode()
            token = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)[w.codes]
            pair = np.unique(token[token >= 0].astype(np.int64) * batch.num_rows + w.doc[token >= 0])
            token, doc = pair // batch.num_rows, pair % batch.num_rows
            n = len(coded.dictionary)
            yield pa.record_batch(
                [
                    pa.array([kind] * n), coded.dictionary.cast(pa.string()),
                    pa.array(np.bincount(token, weights=toxic[doc], minlength=n).astype(np.int64)),
                    pa.array(np.bincount(token, minlength=n).astype(np.int64)),
                ],
                names=["kind", "token", "toxic", "docs"],
            )


def learn_lexicon(sample: DataFrame, toxic: int, clean: int, entries: int) -> Lexicon:
    """The words and stems that tell toxic documents best, at most `entries` of each."""
    t, c = F.col("toxic"), F.col("docs") - F.col("toxic")
    odds = F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))
    sure = F.col("odds") / F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    scored = (
        sample.select("text", "toxic").mapInArrow(_tokens, "kind string, token string, toxic bigint, docs bigint")
        .groupBy("kind", "token").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))
        .filter("toxic >= 5").withColumn("odds", odds).withColumn("sure", sure)
        .filter("odds > 3 AND sure > 4 AND length(token) > 1")
    )
    found = {
        kind: scored.filter(F.col("kind") == kind).orderBy(F.desc("sure"), "token").limit(entries).collect() for kind in "ws"
    }
    return Lexicon(*({r["token"]: r["odds"] for r in found[k]} for k in "ws"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, entries: int = 400) -> Model:
    """Fit on a sample of at most about `max_rows` of the labelled documents, chosen by a hash.

    labels: doc_id and toxic (0 or 1; others are left out; of several labels of an id the largest
    counts). Half of the sample feeds the lexicons and a part of the trees' rows is kept for
    calibration, so that neither is judged on what it has learned by heart.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if not n:
        return Model()
    chosen = known.filter(sampled(max_rows / n, 21, ("doc_id",)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.limit(2 * max_rows)), "doc_id")
    sample = stored(rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(8)).cast("int")))
    sizes = {r["part"] < 4: (r["t"], r["n"]) for r in sample.groupBy(F.when(F.col("part") < 4, 0).otherwise(4).alias("part")).agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    toxic, total = sizes.get(True, (0, 0))
    both = [sum(x) for x in zip(*sizes.values(), strict=True)] if sizes else [0, 0]
    if not both[0] or both[0] == both[1]:
        return Model(base=both[0] / both[1] if both[1] else 0.0)
    lexicon = learn_lexicon(sample.filter("part < 4"), toxic, total - toxic, entries)

    @tidy
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            x = features(batch.column("text"), lexicon)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("toxic"), batch.column("part"), pa.array(list(x), pa.list_(pa.float32()))],
                names=["doc_id", "toxic", "part", "x"],
            )

    found = sample.select("doc_id", "toxic", "part", "text").mapInArrow(measure, "doc_id bigint, toxic int, part int, x array<float>").toArrow().sort_by("doc_id")
    x = np.array(found["x"].to_pylist(), np.float32).reshape(-1, FEATURES)
    y, part = found["toxic"].to_numpy().astype(float), found["part"].to_numpy()
    learn = part != 7
    if not 0 < y[learn].sum() < learn.sum():
        return Model(base=float(y.mean()))
    trees = Trees(x[learn], y[learn])
    points = isotonic(trees.score(x[~learn]), y[~learn]) if 0 < y[~learn].sum() < (~learn).sum() else None
    return Model(lexicon, trees, points)


def score(docs: DataFrame, model: Model, held: Column | None = None, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from the threshold on) of each whole text.

    Only text is looked at; null counts as empty, and an empty text gets the score of its features.
    Without labels of both kinds the score is the share of toxic ones (0 without any label).
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            s = model.predict(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.lit(False) if held is None else held).alias("held"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, fold: int = 1, of: int = 3, max_rows: int = 16_000) -> DataFrame:
    """Train on labels outside the fold, then score every document; see `train` and `score`."""
    held = held_out(fold, of)
    model = train(docs, labels.filter(~held), max_rows)
    return score(docs, model, held)
