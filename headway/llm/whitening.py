"""Whitening of embeddings by shifted Cholesky QR.

The rows' sums are exact, so rows are centred exactly before anything is multiplied. A pass over the
rows takes the Gram matrix of the centred rows; its Cholesky factor R (of a slightly shifted matrix,
so that it always exists) turns them into nearly orthonormal ones by triangular solves. Further
passes do the same with what the factors so far leave, until the Gram matrix is the unit matrix. The
composed factors have the singular values and right vectors of the rows, which are the components.
What comes to the driver are matrices of the vectors' length; rows never do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import tidy

SCALE, OFFSET = 1024, 100_000
# Entries beyond this have no x that a long and a double both hold.
MOST = float(1 << 51)
PASSES = 5
ROUNDING = 1.1e-16
# Singular values below this part of the largest one are rounding.
LEAST = 1e-10
EXACT = pa.decimal128(38, 0)
RESULT = pa.schema(
    [
        ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", EXACT), ("whitened", pa.float64()),
        ("explained", pa.float64()), ("identity_error", pa.float64()),
    ]
)
RESULT_DDL = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


class Sums(NamedTuple):
    """Number of vectors of one length and the exact sum of each dimension."""

    n: int
    total: list[int]


class Fit(NamedTuple):
    """Sums, components (rows), their variances, and the trace of the covariance."""

    sums: Sums
    components: np.ndarray
    variances: np.ndarray
    trace: float


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * SCALE).astype(np.int64) + OFFSET


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, x) for each length of vectors in a batch."""
    column = batch.column("vector")
    size = np.asarray(column.value_lengths())
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield length, rows, whole_numbers(values.reshape(len(rows), length))


def gaps(x: np.ndarray, sums: Sums) -> np.ndarray:
    """n * x - S, exactly: as long, or as Python's integers where a square's sum might not fit."""
    most = sums.n * int(np.abs(x).max(initial=0)) + max(map(abs, sums.total), default=0)
    if most < 1 << 62:
        return sums.n * x - np.array(sums.total, np.int64)
    return sums.n * x.astype(object) - np.array(sums.total, object)


def centred(x: np.ndarray, sums: Sums) -> np.ndarray:
    return (gaps(x, sums) / sums.n).astype(np.float64)


def deviations(gap: np.ndarray) -> list[int]:
    most = max(int(gap.max(initial=0)), -int(gap.min(initial=0)))
    if gap.dtype == object or most * most * max(1, gap.shape[1]) >= 1 << 63:
        gap = gap.astype(object)
    return (gap * gap).sum(axis=1).tolist()


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, column by column."""
    found = np.empty_like(rows)
    for j in range(rows.shape[1]):
        found[:, j] = (rows[:, j] - found[:, :j] @ upper[:j, j]) / upper[j, j]
    return found


def factor(gram: np.ndarray, n: int) -> np.ndarray:
    """The upper Cholesky factor, of the matrix with a shift where it has none of its own."""
    d = len(gram)
    try:
        if np.linalg.eigvalsh(gram)[0] > 0.1:  # nearly orthonormal rows need no shift
            return np.linalg.cholesky(gram).T
    except np.linalg.LinAlgError:
        pass
    shift = 11 * (n * d + d * (d + 1)) * ROUNDING * np.trace(gram)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 100


def _usable(rows: DataFrame) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")).filter(
        (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST))
    )


def _sums(vectors: DataFrame) -> dict[int, Sums]:
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for length, rows, x in by_length(batch):
                own = held.setdefault(length, [0, [0] * length])
                own[0] += len(rows)
                # Halves, so that no sum of a batch leaves a long.
                high, low = x >> 31, x & 0x7FFFFFFF
                own[1] = [t + (h << 31) + s for t, h, s in zip(own[1], high.sum(axis=0).tolist(), low.sum(axis=0).tolist(), strict=True)]
        for length, (n, total) in held.items():
            k = range(length)
            yield pa.record_batch(
                [pa.array([length] * length), pa.array(k, pa.int64()), pa.array([n] * length), pa.array([Decimal(t) for t in total], EXACT)],
                names=["length", "place", "n", "total"],
            )

    parts = vectors.mapInArrow(run, "length bigint, place bigint, n bigint, total decimal(38,0)")
    found = parts.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    sums: dict[int, Sums] = {}
    for r in sorted(found, key=lambda r: (r["length"], r["place"])):
        sums.setdefault(r["length"], Sums(r["n"], [])).total.append(int(r["total"]))
    return sums


def _grams(vectors: DataFrame, sums: dict[int, Sums], factors: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """The Gram matrix of what the factors make of the centred rows, for each length; summed by matrix row."""
    schema = pa.schema([("length", pa.int64()), ("place", pa.int64()), ("line", pa.list_(pa.float64()))])

    def lines(length: int, places: Iterable[int], matrix: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([[length] * len(matrix), list(places), list(matrix)], schema=schema)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in by_length(batch):
                rows = centred(x, sums[length])
                for r in factors.get(length, ()):
                    rows = solved(rows, r)
                held[length] = held.get(length, 0.0) + rows.T @ rows
        for length, gram in held.items():
            yield lines(length, range(length), gram)

    @tidy
    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(x) for x in table["line"].to_pylist()], axis=0)
        return pa.Table.from_batches([lines(table["length"][0].as_py(), [table["place"][0].as_py()], total[None, :])])

    ddl = "length bigint, place bigint, line array<double>"
    found = vectors.mapInArrow(run, ddl).groupBy("length", "place").applyInArrow(add, ddl).collect()
    grams: dict[int, list] = {}
    for r in sorted(found, key=lambda r: (r["length"], r["place"])):
        grams.setdefault(r["length"], []).append(r["line"])
    return {length: np.array(g) for length, g in grams.items()}


def fit(vectors: DataFrame, most: int) -> dict[int, Fit]:
    """The components of each length of vectors, up to `most` of them."""
    sums = _sums(vectors)
    factors: dict[int, list[np.ndarray]] = {length: [] for length in sums}
    trace: dict[int, float] = {}
    grams: dict[int, np.ndarray] = {}
    for _ in range(PASSES):
        if not sums:
            break
        grams = _grams(vectors, sums, factors)
        trace = trace or {length: float(np.trace(g)) for length, g in grams.items()}
        ready = lambda length: trace[length] == 0 or bool(factors[length]) and np.abs(grams[length] - np.eye(length)).max() < 1e-12
        if all(map(ready, grams)):
            break
        for length, gram in grams.items():
            if trace[length] > 0:
                factors[length].append(factor(gram, sums[length].n))
    else:  # the rows that the last factors leave
        grams = _grams(vectors, sums, factors)
    found = {}
    for length, gram in grams.items():
        # The root of what is left of the Gram matrix, the unit matrix but for rounding and for vectors of lower rank.
        e, u = np.linalg.eigh((gram + gram.T) / 2)
        whole = np.sqrt(np.maximum(e, 0))[:, None] * u.T
        for r in reversed(factors[length]):
            whole = whole @ r
        _, s, v = np.linalg.svd(whole)
        few = np.flatnonzero(s > LEAST * s[0])[:most] if trace[length] > 0 else np.empty(0, int)
        n = sums[length].n
        found[length] = Fit(sums[length], v[few], s[few] ** 2 / n, float((s**2).sum() / n))
    return found


def _identity_errors(vectors: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """For each length the largest entry of the whitened rows' covariance minus the unit matrix."""
    schema = pa.schema([("length", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("spread", pa.list_(pa.float64()))])
    Part = tuple[int, np.ndarray, np.ndarray]

    def joined(one: Part | None, two: Part) -> Part:
        """Numbers, means and centred products of two parts as those of both."""
        if one is None:
            return two
        n, gap = one[0] + two[0], two[1] - one[1]
        return n, one[1] + gap * (two[0] / n), one[2] + two[2] + np.outer(gap, gap) * (one[0] * two[0] / n)

    def rows_of(held: dict[int, Part]) -> pa.RecordBatch:
        return pa.record_batch(
            [list(held), [p[0] for p in held.values()], [p[1] for p in held.values()], [p[2].ravel() for p in held.values()]], schema=schema
        )

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Part] = {}
        for batch in batches:
            for length, _, x in by_length(batch):
                white = whitened(x, fits[length])
                own = white - white.mean(axis=0)
                held[length] = joined(held.get(length), (len(x), white.mean(axis=0), own.T @ own))
        yield rows_of(held)

    def parts(rows: Iterable[dict]) -> dict[int, Part]:
        held: dict[int, Part] = {}
        for r in rows:
            mean = np.asarray(r["mean"])
            held[r["length"]] = joined(held.get(r["length"]), (r["n"], mean, np.asarray(r["spread"]).reshape(len(mean), len(mean))))
        return held

    @tidy
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield rows_of(parts(r for batch in batches for r in batch.to_pylist()))

    ddl = "length bigint, n bigint, mean array<double>, spread array<double>"
    found = vectors.mapInArrow(run, ddl).repartition(16).mapInArrow(add, ddl).collect()
    return {
        length: float(np.abs(spread / n - np.eye(len(spread))).max(initial=0.0)) for length, (n, _, spread) in parts(r.asDict() for r in found).items()
    }


def whitened(x: np.ndarray, own: Fit) -> np.ndarray:
    return centred(x, own.sums) @ (own.components / np.sqrt(own.variances)[:, None]).T


def whiten(rows: DataFrame, most: int = 8) -> DataFrame:
    """Each vector on the first `most` principal components, each with variance one.

    `rows` has vec_id and embedding. x = floor(1024 * entry) + 100000. Returns for each row and
    component: vec_id, component from 1 by falling variance, n (vectors), deviation (the exact sum of
    (n * x - S)^2 over the dimensions, S being their sums; null from 10^38 on), whitened, explained (the component's share
    of the variance) and identity_error (the largest entry of the whitened rows' covariance minus the
    unit matrix). Covariances have the divisor n. Rows take no part whose vector is null, empty, holds
    a null or non-finite entry, or one of 2^51 or more, whose x no long holds. Zero vectors do.
    Vectors of different length are whitened by themselves, each length with its own n. Components
    without variance do not exist: equal vectors, or a single one, give no row, nor does an empty
    table. Repeated rows each count and each get rows; a null vec_id stays null.
    """
    vectors = _usable(rows)
    fits = fit(vectors, most)
    errors = _identity_errors(vectors, fits) if fits else {}

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, own_rows, x in by_length(batch):
                own = fits[length]
                k, m = len(own.variances), len(x)
                if not k:
                    continue
                exact = np.repeat(np.array([Decimal(d) if d < 10**38 else None for d in deviations(gaps(x, own.sums))], object), k)
                share = own.variances / own.trace
                ids = batch.column("vec_id").take(pa.array(np.repeat(own_rows, k)))
                yield pa.record_batch(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(k * m, own.sums.n)),
                        pa.array(exact, EXACT), pa.array(whitened(x, own).ravel()), pa.array(np.tile(share, m)),
                        pa.array(np.full(k * m, errors[length])),
                    ],
                    schema=RESULT,
                )

    return vectors.mapInArrow(run, RESULT_DDL)
