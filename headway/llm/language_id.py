"""Language identification: sparse multinomial logistic regression on character n-grams.

N-grams of one to three letters are hashed into a fixed number of slots and weighted by TF-IDF. The
regression is trained with follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalty),
and its scores are calibrated by one temperature. Document frequencies come from every labelled
training row, the weights from a bounded sample of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.shared import sliced, tidy

SLOTS = 1 << 13
BATCH_BYTES, BATCH_ROWS = 2 << 20, 256  # counts are dense: rows are bounded too
UNKNOWN = "und"
_STEPS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)]
RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    global _LETTER
    if "_LETTER" not in globals():
        _LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])
    found = _LETTER[np.minimum(codes, (1 << 16) - 1)]
    high = np.flatnonzero(codes >= 1 << 16)
    found[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    return found


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(documents x SLOTS n-gram counts, whether a document has a letter).

    Letters are in lower case; of what lies between two runs of letters one blank stays.
    """
    lowered = [f" {(t or '').lower()} " for t in texts]
    size = np.fromiter(map(len, lowered), np.int64, len(lowered))
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), size)
    letter = letters(codes)
    starts = np.zeros(len(codes), bool)
    starts[np.concatenate([[0], np.cumsum(size)[:-1]])] = True
    stays = letter | starts
    stays[1:] |= letter[:-1]
    value, doc, letter = np.where(letter, codes, np.uint32(32))[stays].astype(np.uint32), doc[stays], letter[stays]
    has = np.bincount(doc[letter], minlength=len(texts)) > 0
    total = np.zeros(len(texts) * SLOTS, np.int64)
    gram = value * _STEPS[0]
    for n in range(1, 4):
        if n > 1:
            gram = gram[:-1] * _STEPS[1] + value[n - 1 :]
        slot = ((gram ^ (gram >> np.uint32(15))) * _STEPS[2]) >> np.uint32(32 - 13)
        inside = doc[: len(gram)] == doc[n - 1 :]
        total += np.bincount((doc[: len(gram)] * SLOTS + slot)[inside], minlength=len(total))
    return total.reshape(len(texts), SLOTS), has


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (slots and a bias x languages), temperature."""

    languages: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.ones(SLOTS))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((SLOTS + 1, 0)))
    temperature: float = 1.0

    def features(self, grams: np.ndarray) -> np.ndarray:
        x = np.log1p(grams.astype(np.float32)) * self.idf.astype(np.float32)
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.maximum(norm, 1e-9)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1].astype(np.float32) + self.weights[-1].astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        grams, has = counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.logits(self.features(grams)).astype(np.float64) / self.temperature)
        best = p.argmax(axis=1)
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
        return names, np.where(has, p.max(axis=1), 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int,
    epochs: int, alpha: float, beta: float, l1: float, l2: float,
) -> np.ndarray:
    """Weights by FTRL-proximal; rows are (slots, values), the last slot is the bias."""
    z, n = np.zeros((SLOTS + 1, classes)), np.zeros((SLOTS + 1, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            slots, values = rows[i]
            own_z, own_n = z[slots], n[slots]
            w = weights(own_z, own_n)
            p = softmax(values @ w)
            p[target[i]] -= 1
            g = values[:, None] * p
            more = own_n + g * g
            z[slots] = own_z + g - (np.sqrt(more) - np.sqrt(own_n)) / alpha * w
            n[slots] = more
    return weights(z, n)


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(target)), target], 1e-12)).mean()

    low, high, step = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - step * (high - low), low + step * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def held_out(fold: int, of: int) -> Column:
    """Whether the CRC-32 of doc_id as text leaves that remainder; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of == fold


def sampled(rate: Column | float, seed: int, by: tuple[str, ...] = ("doc_id", "text")) -> Column:
    """By id and text, so that rows without an id, or under one, are drawn one by one; or by other columns."""
    return F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(1 << 40)) < F.lit(float(1 << 40)) * rate


@tidy
def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(SLOTS, np.int64), 0
    for batch in sliced(batches, "text", BATCH_BYTES, BATCH_ROWS):
        grams, _ = counts(batch.column("text").to_pylist())
        total += (grams > 0).sum(axis=0)
        rows += batch.num_rows
    yield pa.record_batch([pa.array([total.tolist()]), pa.array([rows])], names=["df", "n"])


@tidy
def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        total += batch.column("df").flatten().to_numpy().reshape(-1, SLOTS).sum(axis=0)
        rows += sum(batch.column("n").to_pylist())
    yield pa.record_batch([pa.array([total.tolist()]), pa.array([rows])], names=["df", "n"])


def train(docs: DataFrame, max_rows: int = 6000, epochs: int = 3) -> Model:
    """Fit a model on the rows of docs (doc_id, text, lang) that have text and language.

    Every row counts for the document frequencies, and every language is learned. The weights and the
    temperature are fitted on a sample of at most `max_rows` rows, spread evenly over the languages and
    chosen by a hash; where that would be less than 8 rows of a language, it has up to 8 of each.
    """
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model()
    languages = sorted(sizes)
    each = max(8, max_rows // len(languages))
    number = {name: i for i, name in enumerate(languages)}
    merged = "df array<bigint>, n bigint"
    partial = rows.select("text").mapInArrow(_frequencies, merged)
    found = partial.repartition(16).mapInArrow(_added, merged).collect()
    df, n = np.sum([r["df"] for r in found], axis=0), sum(r["n"] for r in found)
    model = Model(languages, np.log((1 + n) / (1 + df)) + 1, np.zeros((SLOTS + 1, len(languages))))

    @tidy
    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, target, check = [], [], []
        for batch in sliced(batches, "text", BATCH_BYTES, BATCH_ROWS):
            grams, _ = counts(batch.column("text").to_pylist())
            for x, lang, h in zip(model.features(grams), batch.column("lang").to_pylist(), batch.column("h").to_pylist(), strict=True):
                slots = np.append(np.flatnonzero(x), SLOTS)
                examples.append((h, slots, np.append(x[slots[:-1]], 1.0)))
                target.append(number[lang])
        order = sorted(range(len(examples)), key=lambda i: examples[i][0])
        # A fifth is for the temperature, but each language's first example is learned.
        first = {target[i]: i for i in reversed(order)}
        check = [i for i in order if examples[i][0] % 5 == 0 and first[target[i]] != i]
        learn = [i for i in order if examples[i][0] % 5 or first[target[i]] == i]
        model.weights = ftrl([examples[i][1:] for i in learn], np.array([target[i] for i in learn]), len(languages), epochs, 0.5, 1.0, 0.02, 0.01)
        if check:
            logits = np.array([v @ model.weights[s] for _, s, v in (examples[i] for i in check)])
            model.temperature = temperature(logits, np.array([target[i] for i in check]))
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # Few rows: a language with less than 8 times as many as wanted is drawn whole, and cut to the number then.
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, 1.0 if v < 8 * each else 1.25 * each / v)]), F.col("lang"))
    drawn = rows.filter(sampled(rate, 5)).select("text", "lang", F.xxhash64("doc_id", "text", F.lit(9)).alias("h"))
    # Copies of a row are drawn together: a limit for each language keeps them from filling the task.
    sample = drawn.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("place") <= each).drop("place")
    return pickle.loads(sample.repartition(1).mapInArrow(fit, "model binary").first()[0])


def identify(docs: DataFrame, model: Model, held: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of each row's whole text.

    Only text is looked at. A null text, or one without a letter, is `und` with score 0; so is any
    text if the model knows no language. Repeated rows each get a row. `held` fills held_out.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES, BATCH_ROWS):
            names, score = model.predict(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), batch.column("held"), pa.array(names), pa.array(score)], schema=RESULT)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.lit(False) if held is None else held).alias("held"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, fold: int = 2, of: int = 4, max_rows: int = 6000) -> DataFrame:
    """Train on the rows outside the fold, then identify every row; see `train` and `identify`."""
    held = held_out(fold, of)
    model = train(docs.filter(~held), max_rows)
    return identify(docs, model, held)


def keep_identified(docs: DataFrame, model: Model, margin: float = 2 / 15) -> DataFrame:
    """The rows of docs, all columns, in whose text one language stands out.

    With k languages that is a score of 1/k + margin * (1 - 1/k) or more: `margin` of the way from
    knowing nothing to being sure. Short but clean texts stay. Null texts and texts without a letter
    go, as does every row if the model knows no language.
    """
    k = max(1, len(model.languages))
    least = 1 / k + margin * (1 - 1 / k) - 1e-9

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES, BATCH_ROWS):
            names, score = model.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array((np.array(names) != UNKNOWN) & (score >= least)))

    return docs.mapInArrow(run, docs.schema)
