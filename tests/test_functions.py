import random

import pytest
from pyspark.sql import functions as F

from headway.functions import geo, labels, responses, times


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_gtfs_seconds_and_hours(spark):
    clocks = ["05:00:00", " 5:00:00", "5:00:00", "24:00:00", "25:10:05", "", None, "bad"]
    assert column(spark, clocks, times.gtfs_seconds) == [
        18000, 18000, 18000, 86400, 90605, None, None, None
    ]
    assert column(spark, clocks, times.departure_hour) == [5, 5, 5, 24, 25, None, None, None]
    assert column(spark, clocks[:5], lambda c: times.departure_hour(c, wrap=True)) == [
        5, 5, 5, 0, 1
    ]


def test_severity_limits_and_missing_ratio(spark):
    ratios = [1.0, 1.1, 1.3, 1.6, 2.0, None]
    assert column(spark, ratios, labels.congestion_severity, "double") == [
        "free_flow", "light", "moderate", "heavy", "severe", "severe"
    ]
    named = column(
        spark, [None], lambda c: labels.congestion_severity(c, null_label="unknown"), "double"
    )
    assert named == ["unknown"]


def test_levels_and_types(spark):
    assert column(spark, [7.9, 8.0, 14.9, 15.0], labels.congestion_level, "double") == [
        "HIGH", "MEDIUM", "MEDIUM", "LOW"
    ]
    assert column(spark, [0, 1, 3, 9, None], labels.route_type_label, "int") == [
        "other", "subway", "bus", "other", "other"
    ]
    assert column(
        spark, [0, 715, None], lambda c: labels.corridor_type_label(c, on_demand=True), "int"
    ) == ["tram", "on_demand", "bus"]


def test_periods(spark):
    hours = [6, 7, 9, 10, 15, 16, 18, 19, 21, 22]
    assert column(spark, hours, times.time_period, "int") == [
        "overnight", "morning_rush", "morning_rush", "midday", "midday", "evening_rush",
        "evening_rush", "evening", "evening", "overnight",
    ]


def test_haversine_and_grid(spark):
    one = spark.range(1)
    km = one.select(
        geo.haversine_km(F.lit(49.2827), F.lit(-123.1207), F.lit(47.6062), F.lit(-122.3321))
    ).first()[0]
    assert km == pytest.approx(195.2, abs=1.0)
    assert column(spark, [49.1, 49.1014, 49.1016], geo.grid_cell, "double") == pytest.approx(
        [round(v / 0.003) * 0.003 for v in (49.1, 49.1014, 49.1016)]
    )


def encode(points):
    text, last = "", (0, 0)
    for point in points:
        now = tuple(round(v * 1e5) for v in point)
        for step in (now[0] - last[0], now[1] - last[1]):
            bits = ~(step << 1) if step < 0 else step << 1
            while bits >= 32:
                text += chr((bits & 31 | 32) + 63)
                bits >>= 5
            text += chr(bits + 63)
        last = now
    return text


def test_polylines(spark):
    rng = random.Random(4)
    lines = [
        [(round(rng.uniform(-90, 90), 5), round(rng.uniform(-180, 180), 5)) for _ in range(n)]
        for n in (1, 2, 50, 0, 7)
    ]
    published = "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
    texts = [published, "", None, *[encode(line) for line in lines]]
    found = column(spark, texts, responses.decode_polyline)
    points = [None if p is None else list(zip(p["lat"], p["lon"])) for p in found]
    assert points[0] == [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]
    assert points[1] == [] and points[2] is None
    assert points[3:] == lines


def test_durations_and_ratio(spark):
    assert column(spark, ["123s", "0s", "x", None], responses.parse_duration) == [
        123, 0, None, None
    ]
    rows = spark.createDataFrame([(100, 80), (0, 80), (100, 0), (None, 80)], "d INT, s INT")
    assert [
        r[0] for r in rows.select(responses.congestion_ratio(F.col("d"), F.col("s"))).collect()
    ] == [1.25, None, None, None]


def test_route_from_corridor(spark):
    ids = ["route_099_seg_2", "route_R4_seg_11", "corridor_01"]
    assert column(spark, ids, labels.route_from_corridor) == ["099", "R4", ""]


def test_cache_keys(spark):
    at = F.lit("2024-01-07 23:50:00").cast("timestamp")
    row = spark.range(1).select(
        times.quarter_key(at), times.quarter_key(at, "America/Vancouver", prefix="arterial_")
    ).first()
    assert tuple(row) == ("23_1_q45", "arterial_15_1_q45")
