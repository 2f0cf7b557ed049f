import math
import random

from headway.operators.shapes import longest_shape
from headway.operators.vehicles import grid_congestion, paint_routes, vehicle_speeds

SCHEMA = "id STRING, ts LONG, lat DOUBLE, lon DOUBLE, route STRING, speed DOUBLE"


def km(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(
        math.radians(lat2)
    ) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def brute(rows):
    out, last = [], {}
    for vid, ts, lat, lon, route, speed in sorted(rows):
        value = speed if speed and speed > 0 else None
        if value is None and vid in last:
            was = last[vid]
            moved, gap = km(was[1], was[2], lat, lon), ts - was[0]
            if 5 < gap < 120 and moved > 0.005:
                value = round(moved / (gap / 3600), 1)
        last[vid] = (ts, lat, lon)
        if value is not None and value < 80:
            out.append((vid, ts, value))
    return out


def test_gaps_moves_and_limits(spark):
    step = 0.0005  # about 55 m
    rows = []
    for n, gap in enumerate((4, 5, 6, 119, 120)):
        rows += [(f"g{n}", 1000, 49.0, -123.0, "1", None), (f"g{n}", 1000 + gap, 49.0 + step, -123.0, "1", 0.0)]
    for n, move in enumerate((0.000035, 0.000055)):  # about 4 m and 6 m
        rows += [(f"m{n}", 1000, 49.0, -123.0, "1", None), (f"m{n}", 1030, 49.0 + move, -123.0, "1", None)]
    rows += [("r1", 1000, 49.0, -123.0, "1", 79.9), ("r2", 1000, 49.0, -123.0, "1", 80.0)]
    found = vehicle_speeds(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["id"] for r in found.collect()) == ["g2", "g3", "m1", "r1"]


def test_sliced_speeds_equal_brute_force(spark):
    rng = random.Random(2)
    rows, seen = [], set()
    for n in range(600):
        vid = "hot" if n % 3 == 0 else f"v{rng.randrange(20)}"
        ts = 10_000 + rng.randrange(9000)
        if (vid, ts) not in seen:
            seen.add((vid, ts))
            rows.append((vid, ts, 49 + rng.random() * 0.003, -123 + rng.random() * 0.003, "7",
                         rng.choice([None, None, 0.0, 33.3])))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for slice_s in (150, 1800):
        found = vehicle_speeds(df, slice_s=slice_s)
        assert sorted((r["id"], r["ts"], r["speed_kmh"]) for r in found.collect()) == brute(rows)


def test_grid_counts_and_routes(spark):
    rows = [("a", 49.0, -123.0, "1", 5.0), ("b", 49.0001, -123.0, "2", 10.0), ("c", 49.2, -123.0, "1", 40.0)]
    speeds = spark.createDataFrame(rows, "id STRING, lat DOUBLE, lon DOUBLE, route STRING, speed_kmh DOUBLE")
    cells = grid_congestion(speeds).orderBy("lat").collect()
    assert [(c["avg_speed"], c["level"], c["count"], c["routes"]) for c in cells] == [
        (7.5, "HIGH", 2, ["1", "2"]), (40.0, "LOW", 1, ["1"])
    ]


def test_painted_pieces_for_small_and_large_shapes(spark):
    sizes = {"one": 1, "two": 2, "s10": 10, "s61": 61, "s95": 95}
    points = [(s, i, 49.0 + i * 0.001, -123.0) for s, n in sizes.items() for i in range(n)]
    shapes = spark.createDataFrame(points, "shape_id STRING, shape_pt_sequence INT, shape_pt_lat DOUBLE, shape_pt_lon DOUBLE")
    labels = spark.createDataFrame([(s, s) for s in sizes], "shape_id STRING, route STRING")
    speeds = spark.createDataFrame([(s, 9.96, 4) for s in sizes], "route STRING, avg_speed DOUBLE, samples LONG")
    painted = paint_routes(speeds, shapes, labels).collect()
    for name, n in sizes.items():
        step = max(1, n // 30)
        starts = list(range(0, n - step, step)) if n >= 2 else []
        mine = sorted((p["start_lat"], p["end_lat"]) for p in painted if p["route"] == name)
        assert mine == [(49.0 + i * 0.001, 49.0 + (i + step) * 0.001) for i in starts]
    assert {(p["level"], p["speed"]) for p in painted} == {("MEDIUM", "10.0 km/h")}
    assert longest_shape(shapes, labels, "route").count() == len(sizes)
