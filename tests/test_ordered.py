"""Block-wise operators against plain windows, with blocks small enough to matter."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.operators.ordered import (
    consecutive_pairs,
    sample_every_nth,
    stratified_sample,
    strided_pick,
    with_next,
    with_position,
)


@pytest.fixture(scope="module")
def groups(spark):
    """One hot group with a third of all rows and gaps in its order, many small ones."""
    rng = random.Random(5)
    rows = [("hot", s, float(s)) for s in rng.sample(range(1000), 300)]
    for g in range(60):
        start = rng.choice([0, 0, 0, 40, 500])
        rows += [(f"g{g}", start + s, rng.random()) for s in rng.sample(range(30), 10)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k STRING, o INT, v DOUBLE").cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("width", [3, 16, 4096])
def test_position_equals_row_number(groups, width):
    w = Window.partitionBy("k").orderBy("o")
    plain = groups.select(
        "*", (F.row_number().over(w) - 1).cast("long").alias("position"),
        F.count("*").over(Window.partitionBy("k")).alias("n"),
    )
    assert rows(with_position(groups, ["k"], "o", size="n", width=width)) == rows(plain)


@pytest.mark.parametrize("width", [3, 16, 4096])
def test_next_equals_lead(groups, width):
    w = Window.partitionBy("k").orderBy("o")
    plain = groups.select("*", F.lead("o").over(w).alias("no"), F.lead("v").over(w).alias("nv"))
    assert rows(with_next(groups, ["k"], "o", {"no": "o", "nv": "v"}, width=width)) == rows(plain)


def test_position_with_major_order(spark):
    data = spark.createDataFrame(
        [("r", "b", 5), ("r", "a", 9), ("r", "a", 2), ("r", "b", 1)], "k STRING, m STRING, o INT"
    )
    placed = with_position(data, ["k"], "o", major=["m"], width=3)
    assert rows(placed) == [("r", "a", 2, 0), ("r", "a", 9, 1), ("r", "b", 1, 2), ("r", "b", 5, 3)]


def test_every_tenth_of_21_points_and_their_pairs(spark):
    points = spark.createDataFrame(
        [("s", i + 1, 49.0 + i, -123.0 - i) for i in range(21)],
        "shape STRING, seq INT, lat DOUBLE, lon DOUBLE",
    )
    sampled = sample_every_nth(points, ["shape"], "seq", 10)
    assert [r["seq"] for r in sampled.orderBy("seq").collect()] == [1, 11, 21]
    numbered = sampled.select(
        "shape", (F.col("position") / 10).cast("long").alias("nth"), "lat", "lon"
    )
    pairs = consecutive_pairs(numbered, ["shape"], "nth", "lat", "lon").orderBy("nth").collect()
    assert [(p["lat"], p["next_lat"]) for p in pairs] == [(49.0, 59.0), (59.0, 69.0)]


@pytest.mark.parametrize("k", [1, 3, 7, 10, 25])
def test_strided_pick_places(groups, k):
    expected = []
    for key, size in [("hot", 300), *[(f"g{g}", 10) for g in range(60)]]:
        expected += [
            (key, i, i if size <= k else int(i * size / k)) for i in range(min(k, size))
        ]
    placed = with_position(groups, ["k"], "o")
    picked = strided_pick(groups, ["k"], "o", k).join(placed.select("k", "o", "position"), ["k", "o"])
    assert rows(picked.select("k", "pick", "position")) == sorted(expected, key=repr)


def test_stratified_sample_spreads_over_groups(groups):
    chosen = stratified_sample(groups, "k", "o", cap=200).collect()
    # 61 groups share 200 rows: 3 each, 183 in all.
    assert len(chosen) == 183
    assert {sum(1 for r in chosen if r["k"] == k) for k in ("hot", "g1", "g59")} == {3}


def test_stratified_sample_loses_no_group(spark):
    data = [(f"r{g}" if g else None, i) for g in range(10) for i in range(5)]
    chosen = stratified_sample(spark.createDataFrame(data, "k STRING, o INT"), "k", "o", cap=4).collect()
    assert sorted(r["k"] for r in chosen) == sorted(["unknown", *(f"r{g}" for g in range(1, 10))])
