"""Range and nearest-neighbour joins against brute force."""

import math
import random

import pytest

from pyspark.sql import functions as F

from headway.operators.ranges import nearest_stops, segments_near_cells, stops_within


def flat(lat1, lon1, lat2, lon2):
    return 111320.0 * math.hypot(lat2 - lat1, (lon2 - lon1) * math.cos(math.radians(lat1)))


@pytest.fixture(scope="module")
def places():
    """A dense town, a pile of stops at one place, lone stops far out."""
    rng = random.Random(11)
    stops = [(f"t{i:03}", 49.25 + rng.gauss(0, 0.02), -123.1 + rng.gauss(0, 0.03)) for i in range(150)]
    stops += [(f"p{i:03}", 49.3, -123.0) for i in range(40)]
    stops += [("far1", -33.9, 151.2), ("far2", 60.1, 24.9), ("far3", 0.0, 179.9)]
    points = [(i, 49.25 + rng.gauss(0, 0.05), -123.1 + rng.gauss(0, 0.08)) for i in range(60)]
    points += [(100, 49.3, -123.0), (101, 10.0, 10.0), (102, -50.0, 170.0), (103, 61.0, 25.0)]
    return stops, points


@pytest.mark.parametrize("k", [1, 5, 60])
def test_nearest_stops(spark, places, k):
    stops, points = places
    found = nearest_stops(
        spark.createDataFrame(points, "point_id INT, lat DOUBLE, lon DOUBLE"),
        spark.createDataFrame(stops, "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE"),
        k,
    )
    mine = {(r["point_id"], r["rank"]): r["stop_id"] for r in found.collect()}
    theirs = {}
    for pid, lat, lon in points:
        ranked = sorted((flat(lat, lon, s[1], s[2]), s[0]) for s in stops)[:k]
        theirs.update({(pid, n + 1): stop for n, (_, stop) in enumerate(ranked)})
    assert mine == theirs


def test_nearest_with_fewer_stops_than_asked(spark):
    stops = spark.createDataFrame(
        [("a", 49.0, -123.0), ("b", -20.0, 100.0)], "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE"
    )
    points = spark.createDataFrame([(1, 49.1, -123.1)], "point_id INT, lat DOUBLE, lon DOUBLE")
    assert [r["stop_id"] for r in nearest_stops(points, stops, 5).orderBy("rank").collect()] == ["a", "b"]


def test_stops_within(spark, places):
    stops, points = places
    found = stops_within(
        spark.createDataFrame(points, "point_id INT, lat DOUBLE, lon DOUBLE"),
        spark.createDataFrame(stops, "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE"),
    )
    theirs = sorted(
        (p[0], s[0])
        for p in points
        for s in stops
        if abs(s[1] - p[1]) < 0.008 and abs(s[2] - p[2]) < 0.012 and flat(*p[1:], *s[1:]) < 800
    )
    assert sorted((r["point_id"], r["stop_id"]) for r in found.collect()) == theirs


def test_points_of_one_file_are_dealt_to_many_tasks(spark):
    """2,000 points in one partition near 50 stops: their pairs are not all made by one task."""
    points = spark.sql("SELECT id point_id, 49.0 + id * 1e-7 lat, -123D lon FROM range(0, 2000, 1, 1)")
    stops = spark.sql("SELECT CAST(id AS STRING) stop_id, 49.0 + id * 1e-6 stop_lat, -123D stop_lon FROM range(50)")
    made = stops_within(points, stops).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in made) == 100_000
    assert len(made) > 1 and max(r["count"] for r in made) < 50_000


def test_segments_near_cells_limits(spark):
    rng = random.Random(3)
    segments = [(i, 49 + rng.random() * 0.1, -123 + rng.random() * 0.1) for i in range(300)]
    cells = [(49 + c * 0.003, -123 + c * 0.003) for c in range(33)]
    seg = spark.createDataFrame(segments, "n INT, origin_lat DOUBLE, origin_lon DOUBLE")
    cell = spark.createDataFrame(cells, "lat DOUBLE, lon DOUBLE")
    near = {
        (c, s[0]) for c in cells for s in segments
        if abs(s[1] - c[0]) < 0.006 and abs(s[2] - c[1]) < 0.006
    }
    everything = segments_near_cells(cell, seg, ["n"])
    assert {((r["lat"], r["lon"]), r["n"]) for r in everything.collect()} == near
    expected = set()
    for c in sorted(cells)[:30]:
        expected |= {(c, n) for n in sorted(n for cc, n in near if cc == c)[:3]}
    limited = segments_near_cells(cell, seg, ["n"], per_cell=3, max_cells=30)
    assert {((r["lat"], r["lon"]), r["n"]) for r in limited.collect()} == expected


def test_crowded_place(spark):
    """5,000 stops within 200 m: points look at their own surroundings only."""
    rng = random.Random(3)
    stops = [(f"s{i:04}", 49.25 + rng.random() * 0.0018, -123.1 + rng.random() * 0.0018) for i in range(5000)]
    points = [(i, 49.25 + rng.random() * 0.0018, -123.1 + rng.random() * 0.0018) for i in range(300)]
    found = nearest_stops(
        spark.createDataFrame(points, "point_id INT, lat DOUBLE, lon DOUBLE"),
        spark.createDataFrame(stops, "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE"),
        3,
    )
    mine = {(r["point_id"], r["rank"]): r["stop_id"] for r in found.collect()}
    theirs = {}
    for pid, lat, lon in points:
        ranked = sorted((flat(lat, lon, s[1], s[2]), s[0]) for s in stops)[:3]
        theirs.update({(pid, n + 1): stop for n, (_, stop) in enumerate(ranked)})
    assert mine == theirs
