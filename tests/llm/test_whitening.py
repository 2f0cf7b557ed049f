"""Whitening against a plain eigendecomposition with exact sums."""

from fractions import Fraction

import numpy as np
import pytest

from headway.llm.queries import QUERIES
from headway.llm.shared import table
from headway.llm.whitening import factor, solved, whiten

FOLDER = "/root/testdata/sf0.001"


def brute(vectors, most=8):
    """(n, deviations, whitened up to signs, explained) of plain rows of numbers."""
    x = [[int(np.floor(c * 1024)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    own = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)] for row in x])
    _, s, v = np.linalg.svd(own, full_matrices=False)
    e, v = s**2 / n, v.T
    k = min(most, int((s > 1e-10 * max(s[0], 1e-300)).sum()))
    return n, deviations, own @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(rows, vectors, ids):
    n, deviations, white, explained = brute(vectors)
    k = white.shape[1]
    assert len(rows) == len(vectors) * k
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert {c for _, c in got} == set(range(1, k + 1))
    for c in range(k):
        own = np.array([got[i, c + 1]["whitened"] for i in ids])
        scale = 1e-6 * np.abs(white[:, c]).max()
        assert min(np.abs(own - white[:, c]).max(), np.abs(own + white[:, c]).max()) < scale
        assert all(abs(got[i, c + 1]["explained"] / explained[c] - 1) < 1e-4 for i in ids)
    assert all(int(got[i, 1]["deviation"]) == d and got[i, 1]["n"] == n for i, d in zip(ids, deviations, strict=True))
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-4


def test_table(spark):
    own = table(spark, FOLDER, "embeddings").collect()
    check(QUERIES["op13_whitening"](spark, FOLDER).collect(), [r["embedding"] for r in own], [r["vec_id"] for r in own])


@pytest.mark.parametrize("spread", [1.0, 1e-3, 1e-6])
def test_small_variances(spark, spread):
    """Components whose variances lie far apart, which one Cholesky factor of the covariance would lose."""
    rng = np.random.default_rng(8)
    turn, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    vectors = (rng.normal(size=(300, 6)) * [1e6, 1e3, 1e6 * spread, 10, 1e5, 1e4]) @ turn
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    check(whiten(df).collect(), vectors.tolist(), range(300))


def test_lower_rank_few_rows_and_repeats(spark):
    rng = np.random.default_rng(9)
    two = rng.integers(-9, 9, (40, 2)) @ rng.integers(-3, 3, (2, 5)) * 1.0
    vectors = [*two.tolist(), *two[:10].tolist()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    check(whiten(df).collect(), vectors, range(50))
    two = [[1.0, 2.0, 3.0], [3.0, 1.0, 0.5]]
    check(whiten(spark.createDataFrame(list(enumerate(two)), "vec_id bigint, embedding array<double>")).collect(), two, range(2))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0], [1.0, nan, 2.0], [inf, 0.0, 0.0], [0.0, -inf, 1.0], [1e300, 0.0, 0.0]]
    good = [[0.0, 0.0, 0.0], [1.0, 2.0, 3.0], [2.0, -1.0, 0.5], [0.25, 7.0, 1.0], [1.0, 2.0, 3.0]]
    other = [[1.0, 5.0], [2.0, 3.0], [-1.0, 0.0]]
    rows = [(i, v, 1, 2.0, "x") for i, v in enumerate([*odd, *good, *other])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n int, vector double, length string")
    found = whiten(df).collect()
    threes = [r for r in found if r["vec_id"] < len(odd) + len(good)]
    check(threes, good, range(len(odd), len(odd) + len(good)))
    check([r for r in found if r not in threes], other, range(len(odd) + len(good), len(rows)))


def test_rows_without_id_and_no_variance(spark):
    ddl = "vec_id bigint, embedding array<float>"
    assert whiten(spark.createDataFrame([], ddl)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, ddl)).collect() == []
    found = whiten(spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 2.5]), (3, [0.0, 9.0])], ddl)).collect()
    assert sorted(str(r["vec_id"]) for r in found) == ["3", "3", "None", "None", "None", "None"]


def test_huge_entries_stay_exact(spark):
    vectors = [[2.0**50, 1.0], [-(2.0**50), 3.0], [5.0, -(2.0**49)], [0.0, 0.0]]
    rows = whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")).collect()
    check(rows, vectors, range(4))


def test_triangular_solves_and_factors():
    rng = np.random.default_rng(10)
    rows = rng.normal(size=(50, 7)) * np.logspace(0, -9, 7)
    r = factor(rows.T @ rows, 50)
    assert np.allclose(np.tril(r, -1), 0)
    assert np.allclose(solved(rows, r) @ r, rows, atol=1e-12)
    q = rows
    for _ in range(4):
        q = solved(q, factor(q.T @ q, 50))
    assert np.abs(q.T @ q - np.eye(7)).max() < 1e-12
