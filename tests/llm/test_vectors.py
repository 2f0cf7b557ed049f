"""Neighbour search against brute force, odd vectors, and recall under a factor."""

import numpy as np
import pytest

from headway.llm.neighbours import VantageTree, distances, nearest


def brute(items, k):
    found = []
    for q, v in items.items():
        if q % 100 == 0:
            others = [(distances(np.array([v]), np.array([w]))[0], i) for i, w in items.items() if i != q and len(w) == len(v)]
            found += [(q, r, i, d) for r, (d, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(found)


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    good = {i: rng.integers(-2, 3, 4).astype(float).tolist() for i in range(0, 2000, 10)}
    good = {i: v for i, v in good.items() if any(v)}
    good |= {i: [1.0, 2.0, 2.0, 0.0] for i in range(2001, 2100)}  # many copies of one vector
    good |= {5000: [1.0, 1.0], 5001: [2.0, 1.0]}
    bad = [(6000, None), (6100, []), (6200, [0.0] * 4), (6300, [1.0, None, 1.0, 1.0]), (6400, [float("nan")] * 4), (6500, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4)]
    rows = [(i, v, 1) for i, v in [*good.items(), *bad]] + [(0, good[0], 1)] * 2
    found = nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int"), shard_rows=40, block_rows=3)
    assert sorted(tuple(r) for r in found.collect()) == brute(good, 10)


def test_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in nearest(rows).collect()] == [(0, 1, 1, 1.0)]
    assert nearest(rows.filter("vec_id = 1")).collect() == []
    assert nearest(rows.limit(0)).collect() == []


@pytest.mark.parametrize(("factor", "least"), [(1.0, 1.0), (1.3, 0.9)])
def test_recall_and_pruning(factor, least):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(600, 8)) * 0.05 + rng.normal(size=8) for _ in range(8)])
    ids = rng.permutation(len(points))
    tree = VantageTree(ids, points, 11)
    _, found = tree.search(ids[:50], points[:50], 10, factor)
    hits = []
    for q in range(50):
        d = distances(np.broadcast_to(points[q], points.shape), points)
        order = [i for _, i in sorted(zip(d, ids, strict=True)) if i != ids[q]][:10]
        hits.append(len(set(order) & set(found[q].tolist())) / 10)
    assert np.mean(hits) >= least
