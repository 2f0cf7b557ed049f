import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators.scd import current_versions, expire, scd1, scd2, upsert_by_key, versions_at
from headway.plans.schedule import scheduled_times

SCHEMA = "stop_id STRING, snap STRING, name STRING, lat DOUBLE"
STOPS = [
    ("same", "2024-01-05", "A", 1.0), ("same", "2024-01-12", "A", 1.0),
    ("renamed", "2024-01-05", "B", 1.0), ("renamed", "2024-01-12", "B2", 1.0),
    ("moved", "2024-01-05", "C", 1.0), ("moved", "2024-01-19", "C", 2.0),
    ("late", "2024-01-19", "D", 1.0), ("late", "2024-01-05", "D", 1.0),
    ("late", "2024-01-12", "X", 1.0),
    ("blank", "2024-01-05", None, 1.0), ("blank", "2024-01-12", None, 1.0),
    ("gone", "2024-01-05", "E", 1.0), (None, "2024-01-05", "F", 1.0),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_scd2_versions(spark):
    changes = spark.createDataFrame(STOPS, SCHEMA)
    history = scd2(changes, ["stop_id"], "snap")
    assert rows(history) == sorted(
        [
            ("same", "A", 1.0, "2024-01-05", None),
            ("renamed", "B", 1.0, "2024-01-05", "2024-01-12"),
            ("renamed", "B2", 1.0, "2024-01-12", None),
            ("moved", "C", 1.0, "2024-01-05", "2024-01-19"),
            ("moved", "C", 2.0, "2024-01-19", None),
            ("late", "D", 1.0, "2024-01-05", "2024-01-12"),
            ("late", "X", 1.0, "2024-01-12", "2024-01-19"),
            ("late", "D", 1.0, "2024-01-19", None),
            ("blank", None, 1.0, "2024-01-05", None),
            ("gone", "E", 1.0, "2024-01-05", None),
        ],
        key=repr,
    )
    assert current_versions(history).count() == 6


def test_scd1_keeps_newest_and_hides_sequence(spark):
    changes = spark.createDataFrame(STOPS, SCHEMA)
    now = scd1(changes, ["stop_id"], "snap", drop=["snap"])
    assert rows(now) == sorted(
        [
            ("same", "A", 1.0), ("renamed", "B2", 1.0), ("moved", "C", 2.0), ("late", "D", 1.0),
            ("blank", None, 1.0), ("gone", "E", 1.0),
        ],
        key=repr,
    )


changes = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(1, 6), st.sampled_from(["x", "y", None])),
    min_size=1, max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes)
def test_scd2_intervals_are_disjoint_and_replays_do_not_matter(spark, data):
    df = spark.createDataFrame(data, "k STRING, s INT, v STRING")
    history = rows(scd2(df, ["k"], "s"))
    shuffled = data + data
    random.Random(1).shuffle(shuffled)
    again = scd2(spark.createDataFrame(shuffled, "k STRING, s INT, v STRING"), ["k"], "s")
    assert rows(again) == history
    for key in {k for k, _, _ in data}:
        spans = sorted((start, end) for k, _, start, end in history if k == key)
        assert [end for _, end in spans[:-1]] == [start for start, _ in spans[1:]]
        assert spans[-1][1] is None


def test_upsert_and_expiry(spark):
    schema = "k STRING, v INT, at TIMESTAMP"
    old = spark.sql("SELECT 'a' k, 1 v, timestamp'2024-01-01' at UNION ALL SELECT 'b', 1, timestamp'2024-01-02'")
    new = spark.sql("SELECT 'b' k, 2 v, timestamp'2024-01-03' at UNION ALL SELECT 'c', 2, timestamp'2024-01-03'")
    merged = upsert_by_key(old, new, ["k"], "at")
    assert sorted((r["k"], r["v"]) for r in merged.collect()) == [("a", 1), ("b", 2), ("c", 2)]
    late = spark.sql("SELECT 'b' k, 9 v, timestamp'2024-01-01' at")
    assert sorted((r["k"], r["v"]) for r in upsert_by_key(merged, late, ["k"], "at").collect()) == [("a", 1), ("b", 2), ("c", 2)]
    fresh = expire(merged, "at", F.lit("2024-01-03 12:00:00").cast("timestamp"), "24 hours")
    assert sorted(r["k"] for r in fresh.collect()) == ["b", "c"]
    assert merged.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()


def test_versions_at_reads_its_rows_once(spark, tmp_path):
    """Rows come from a file; those long after the last version, before the first and without a date too."""
    asked = [(1, "a", "2020-06-01"), (2, "a", "2031-01-01"), (3, "a", "2019-01-01"), (4, "b", "2040-01-01"), (5, "a", None), (6, "c", "2021-01-01")]
    spark.createDataFrame(asked, "n INT, stop_id STRING, at STRING").write.parquet(f"{tmp_path}/asked")
    changes = [("a", "2020-01-01", "old"), ("a", "2022-03-01", "new"), ("b", "2021-01-01", "b")]
    history = scd2(spark.createDataFrame(changes, "stop_id STRING, at STRING, stop_name STRING"), ["stop_id"], "at")
    found = versions_at(spark.read.parquet(f"{tmp_path}/asked"), history, ["stop_id"], "at")
    assert {r["n"]: r["stop_name"] for r in found.collect()} == {1: "old", 2: "new", 3: None, 4: "b", 5: None, 6: None}
    assert found._jdf.queryExecution().optimizedPlan().toString().count(" parquet") == 1


def test_versions_at_a_date(spark):
    rng = random.Random(5)
    day = lambda: f"20{rng.randrange(10, 25)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
    changes = [(f"s{rng.randrange(6)}", day(), rng.choice("ABC"), 1.0) for _ in range(80)]
    history = scd2(spark.createDataFrame(changes, SCHEMA), ["stop_id"], "snap")
    asked = [(n, rng.choice(["s0", "s1", "s2", "s5", "s9", None]), day()) for n in range(300)]
    asked += [(300 + n, c[0], c[1]) for n, c in enumerate(changes)] + [(900, "s1", None)]
    versions = [tuple(r) for r in history.select("stop_id", "__START_AT", "__END_AT", "name").collect()]

    def held(stop, at):
        names = [n for s, a, e, n in versions if s == stop and at is not None and a <= at and (e is None or at < e)]
        assert len(names) < 2
        return names[0] if names else None

    found = versions_at(spark.createDataFrame(asked, "n INT, stop_id STRING, at STRING"), history, ["stop_id"], "at")
    assert rows(found.select("n", "stop_id", "at", "name")) == sorted([(*a, held(a[1], a[2])) for a in asked], key=repr)
    assert versions_at(spark.createDataFrame([], "stop_id STRING, at STRING"), history, ["stop_id"], "at").collect() == []


def test_segments_show_their_stops_at_the_snapshot_date(spark):
    times = spark.sql("""
        SELECT 't' trip_id, s stop_id, n stop_sequence, '08:00:00' arrival_time, '08:00:30' departure_time,
               1D shape_dist_traveled, d gtfs_snapshot_date
        FROM VALUES ('2024-01-05'), ('2024-01-12') AS v(d), VALUES ('a', 1), ('b', 2) AS w(s, n)""")
    trips = spark.sql("""
        SELECT 't' trip_id, 'r' route_id, 'h' trip_headsign, 0 direction_id, 'x' service_id, d gtfs_snapshot_date
        FROM VALUES ('2024-01-05'), ('2024-01-12') AS v(d)""")
    routes = spark.sql("SELECT 'r' route_id, '007' route_short_name, 'L' route_long_name, 3 route_type")
    changes = spark.sql("""
        SELECT * FROM VALUES ('a', '2024-01-05', 'old', 1D, 1D), ('a', '2024-01-12', 'new', 2D, 2D), ('b', '2024-01-12', 'late', 3D, 3D)
        AS v(stop_id, gtfs_snapshot_date, stop_name, stop_lat, stop_lon)""")
    history = scd2(changes, ["stop_id"], "gtfs_snapshot_date")
    every = scheduled_times(times, trips, routes, history, all_snapshots=True)
    picked = ["gtfs_snapshot_date", "origin_stop_name", "origin_lat", "dest_stop_name"]
    assert rows(every.select(*picked)) == [("2024-01-05", "old", 1.0, None), ("2024-01-12", "new", 2.0, "late")]
    newest = scheduled_times(times, trips, routes, current_versions(history))
    assert rows(newest.select(*picked)) == [("2024-01-12", "new", 2.0, "late")]
    assert newest.columns == every.columns
