"""Streams over files in shuffled order give what the batch operators give."""

import datetime as dt
import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from headway.operators.distinct import distinct_counts, distinct_sketches, merge_sketches
from headway.operators.scd import scd1, scd2, scd2_spliced
from headway.operators.traffic import congestion_patterns, corridor_daily
from headway.operators.vehicles import vehicle_speeds
from headway.plans.live import quarter_hour_readings
from headway.plans.traffic import traffic_readings
from headway.streaming.gold import (
    daily_from_parts,
    gold_stream,
    merge_parts,
    merge_readings,
    patterns_from_parts,
    reading_parts,
)
from headway.streaming.quality import StreamCounts, expect_stream
from headway.streaming.readings import stream_readings
from headway.streaming.tables import (
    merge_batch,
    read_merged,
    refresh_days,
    run_stream,
    scd1_stream,
    scd2_stream,
    upsert_stream,
)
from headway.streaming.vehicles import run_vehicle_speeds

CHANGES = "stop_id STRING, snap STRING, name STRING"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def add_file(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def changes(spark):
    rng = random.Random(7)
    data = [
        (f"s{k}", f"2024-01-{d:02}", rng.choice("AB")) for k in range(20) for d in range(1, 9)
        if rng.random() < 0.8
    ]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_keyed_streams_equal_batch(spark, tmp_path, changes, kind):
    source = f"{tmp_path}/in"
    places = {"target": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/cp", "buckets": 4}
    run, batch = {
        "scd1": (scd1_stream, lambda df: scd1(df, ["stop_id"], "snap")),
        "scd2": (scd2_stream, lambda df: scd2(df, ["stop_id"], "snap")),
    }[kind]
    for part in range(3):  # every round restarts the query from its checkpoint
        add_file(spark.createDataFrame(changes[part::3], CHANGES), source)
        stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(source)
        run(stream, ["stop_id"], "snap", **places).awaitTermination()
        seen = [row for p in range(part + 1) for row in changes[p::3]]
        expected = batch(spark.createDataFrame(seen, CHANGES))
        stored = read_merged(spark, places["target"])
        assert rows(stored.select(*expected.columns)) == rows(expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splices_of_late_and_repeated_changes(spark, seed):
    """Batches in random order, with changes delivered again, others under a known sequence, and nulls."""
    rng = random.Random(seed)
    schema = "a STRING, b INT, snap INT, name STRING, zone STRING, note STRING"
    data = [
        (f"k{rng.randrange(4)}", rng.choice([None, 1, 2]) if rng.random() < 0.1 else 1, rng.choice([None, *range(1, 13)]) if rng.random() < 0.05 else rng.randrange(1, 13),
         rng.choice("AAB"), rng.choice([None, "z"]), str(rng.random()))
        for _ in range(110)
    ]
    keys, found, seen = ["a", "b"], None, []
    for _ in range(5):
        part = rng.sample(data, 30)
        seen += part
        found = scd2_spliced(found, spark.createDataFrame(part, schema), keys, "snap", drop=["note"]).persist()
        expected = scd2(spark.createDataFrame(seen, schema), keys, "snap", drop=["note"])
        assert rows(found.select(*expected.columns)) == rows(expected)


def test_splices_open_neighbours_only(spark):
    """A version far from the change is not laid out: what it was seen at may be wrong and stays."""
    schema = "k STRING, name STRING, __START_AT INT, __END_AT INT, __SEEN_AT ARRAY<INT>"
    held = [("x", c, 10 * i, 10 * i + 10 if i < 6 else None, [10 * i, -99] if i < 3 else [10 * i, 10 * i + 5]) for i, c in enumerate("ABABABA")]
    held.append(("other", "Z", 1, None, [1, -99]))
    late = spark.createDataFrame([("x", 52, "A")], "k STRING, snap INT, name STRING")
    found = {(r["k"], r["__START_AT"]): r for r in scd2_spliced(spark.createDataFrame(held, schema), late, ["k"], "snap").collect()}
    assert [s for k, s in sorted(found) if k == "x"] == [0, 10, 20, 30, 40, 50, 52, 55, 60]
    assert found["x", 0]["__SEEN_AT"] == [-99, 0] and found["other", 1]["__SEEN_AT"] == [1, -99]
    assert (found["x", 52]["name"], found["x", 52]["__END_AT"], found["x", 55]["name"]) == ("A", 55, "B")


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_batches_that_run_again_change_nothing(spark, tmp_path, changes, kind):
    """Whatever a batch that died has left: nothing, its result, or a part of the target."""
    places = {"target": f"{tmp_path}/out", "buckets": 4}
    keys = ["stop_id"]
    merge, batch = {
        "scd1": (lambda old, new: scd1(new if old is None else old.unionByName(new), keys, "snap"), lambda df: scd1(df, keys, "snap")),
        "scd2": (lambda old, new: scd2_spliced(old, new, keys, "snap"), lambda df: scd2(df, keys, "snap")),
    }[kind]
    part = lambda n: spark.createDataFrame(changes[n::4], CHANGES)
    for number in (0, 1, 1):
        merge_batch(part(number), number, keys, merge, **places)
    with pytest.raises(ZeroDivisionError):
        merge_batch(part(2), 2, keys, lambda old, new: 1 / 0, **places)
    merge_batch(part(2), 2, keys, merge, **places)
    gone = next(d for d in os.listdir(places["target"]) if d.startswith("bucket_no="))
    shutil.rmtree(f"{places['target']}/{gone}")  # as if it died between taking the old partition away and giving the new one
    merge_batch(part(2), 2, keys, merge, **places)
    merge_batch(part(3), 3, keys, merge, **places)
    expected = batch(spark.createDataFrame(changes, CHANGES))
    assert rows(read_merged(spark, places["target"]).select(*expected.columns)) == rows(expected)
    merge_batch(part(3).limit(0), 4, keys, merge, **places)
    assert read_merged(spark, places["target"]).count() == expected.count()


def test_a_batch_meets_the_buckets_that_it_touches(spark, tmp_path):
    target, met = f"{tmp_path}/out", []

    def merge(old, new):
        met.append(0 if old is None else old.count())
        return scd1(new if old is None else old.unionByName(new), ["stop_id"], "snap")

    every = spark.createDataFrame([(f"s{i}", "2024-01-01", "A") for i in range(200)], CHANGES)
    merge_batch(every, 0, ["stop_id"], merge, target=target, buckets=16)
    merge_batch(every.filter("stop_id = 's7'"), 1, ["stop_id"], merge, target=target, buckets=16)
    assert met[0] == 0 and 0 < met[1] < 50 and read_merged(spark, target).count() == 200


def test_upserts(spark, tmp_path):
    source = f"{tmp_path}/in"
    schema = "cache_key STRING, at TIMESTAMP, v INT"
    places = {"target": f"{tmp_path}/out", "checkpoint": f"{tmp_path}/cp"}
    for day, v in ((2, 2), (1, 1), (3, 3)):
        keys = ["a", "b"] if day < 3 else ["b", "c"]
        add_file(
            spark.createDataFrame([(k, v) for k in keys], "cache_key STRING, v INT").select(
                "cache_key", F.lit(f"2024-01-0{day}").cast("timestamp").alias("at"), "v"
            ),
            source,
        )
        stream = spark.readStream.schema(schema).parquet(source)
        upsert_stream(stream, ["cache_key"], "at", **places).awaitTermination()
    stored = read_merged(spark, places["target"])
    assert rows(stored.select("cache_key", "v")) == [("a", 2), ("b", 3), ("c", 3)]


VEHICLES = "id STRING, ts LONG, lat DOUBLE, lon DOUBLE, route STRING, speed DOUBLE, n LONG, seen_at TIMESTAMP"


def vehicle_rows(rng):
    data, ts = [], 1000
    for n in range(240):
        ts += rng.choice([10, 30, 45])
        for vid in ("hot", "hot2", f"v{rng.randrange(4)}"):
            data.append((vid, ts, 49 + rng.random() * 0.002, -123 + rng.random() * 0.002, rng.choice(["7", None]),
                         rng.choice([None, None, 20.5]), rng.choice([None, 2**53 + 1 + n]), dt.datetime(2024, 1, 1, 0, 0, 0, n)))
    return data


def test_vehicle_stream_equals_batch(spark, tmp_path):
    rng = random.Random(9)
    data = vehicle_rows(rng)
    # Rows are up to 90 s late, ties and nulls among them; a far one lets the watermark pass the others.
    arrival = sorted(data, key=lambda r: r[1] + rng.randrange(90))
    arrival.append(("far", 10**6, 49.0, -123.0, "7", 5.0, 1, None))
    source, target = f"{tmp_path}/in", f"{tmp_path}/speeds"
    cut = [0, 50, 51, 200, 500, len(arrival)]
    for start, end in zip(cut, cut[1:]):  # every round restarts the query from its checkpoint
        add_file(spark.createDataFrame(arrival[start:end], VEHICLES), source)
        query = run_vehicle_speeds(spark.readStream.schema(VEHICLES).parquet(source), target=target, checkpoint=f"{tmp_path}/cp")
        query.awaitTermination()
    expected = vehicle_speeds(spark.createDataFrame(data, VEHICLES))
    stored = spark.read.parquet(target).select(*expected.columns)
    assert rows(stored) == rows(expected) and stored.count() > 300
    # Silent vehicles have left the state: only the far one is held.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    add_file(spark.createDataFrame([("hot", 1000, 49.5, -123.5, "7", 50.0, 1, None)], VEHICLES), source)
    query = run_vehicle_speeds(spark.readStream.schema(VEHICLES).parquet(source), target=target, checkpoint=f"{tmp_path}/cp")
    query.awaitTermination()
    assert spark.read.parquet(target).count() == expected.count()
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 1


POLLS = """corridor_id STRING, corridor_name STRING, polled_at TIMESTAMP, _file_arrival_time TIMESTAMP, event_id LONG,
    static_duration_seconds INT, duration_seconds INT, congestion_ratio DOUBLE, distance_meters INT, api_response_json STRING"""


def poll_rows(rng, n):
    data = []
    for i in range(n):
        at = dt.datetime(2024, 1, 1, 8) + dt.timedelta(minutes=15 * rng.randrange(n // 8))
        seconds = rng.randrange(250, 900)
        data.append((rng.choice(["route_001_seg_1", "route_002_seg_2", None]), "C", at, rng.choice([None, at + dt.timedelta(seconds=rng.randrange(3))]),
                     i, 300, seconds, rng.choice([None, seconds / 300]), 1000, rng.choice(['{}', '{}', '{"error": 1}'])))
    return data


@pytest.mark.parametrize("keep", ["newest", "first"])
def test_readings_stream_equals_batch(spark, tmp_path, keep):
    rng = random.Random(4)
    data = poll_rows(rng, 200)
    arrival = sorted(data, key=lambda r: r[2] + dt.timedelta(minutes=rng.randrange(40)))
    source, newest = f"{tmp_path}/in", ("_file_arrival_time", "event_id")
    far = (None, "C", None, None, -1, 300, 300, 1.0, 1, "{}")
    far = ("far", *far[1:2], dt.datetime(2025, 1, 1), *far[3:])
    counts = StreamCounts(spark)
    spark.streams.addListener(counts)
    try:
        for part in (arrival[:70], arrival[70:150], [*arrival[150:], far], [arrival[0][:4] + (999,) + arrival[0][5:]]):
            add_file(spark.createDataFrame([("route_001_seg_1", *part[0][1:9], "{}")] if part[0][4] == 999 else part, POLLS), source)
            stream = stream_readings(spark.readStream.schema(POLLS).parquet(source), keep=keep, newest=newest)
            query = run_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
            query.awaitTermination()
        late = query.id
        for _ in range(100):
            if counts.late[str(late)]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert counts.late[str(late)] >= 1
    expected = traffic_readings(spark.createDataFrame(data, POLLS), newest=newest)
    stored = spark.read.parquet(f"{tmp_path}/out").filter("corridor_id <> 'far'").select(*expected.columns)
    if keep == "newest":
        assert rows(stored) == rows(expected)
    else:
        keys = ["corridor_id", "polled_at"]
        assert rows(stored.select(*keys)) == rows(expected.select(*keys))


def test_expectations_of_streams(spark, tmp_path):
    source = f"{tmp_path}/in"
    rules = {"key": "k IS NOT NULL", "positive": "v > 0"}
    for part in ([("a", 1), (None, 2), ("b", -1)], [(None, -5), ("c", None), ("d", 4)]):
        add_file(spark.createDataFrame(part, "k STRING, v INT"), source)

    def run(action, counts, name):
        stream = spark.readStream.schema("k STRING, v INT").option("maxFilesPerTrigger", 1).parquet(source)
        checked = expect_stream(stream, rules, action)
        writer = checked.writeStream.queryName(name).format("parquet").option("path", f"{tmp_path}/{name}")
        query = writer.option("checkpointLocation", f"{tmp_path}/{name}_cp").trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            for _ in range(50):
                if len(counts.batches[name]) > 1 or counts.stopped or action == "fail":
                    break
                time.sleep(0.1)

    counts, strict = StreamCounts(spark), StreamCounts(spark, {"positive": 0})
    spark.streams.addListener(counts)
    try:
        run("warn", counts, "warned")
        run("drop", counts, "dropped")
        with pytest.raises(Exception, match="expectation failed"):
            run("fail", counts, "failed")
        assert spark.read.parquet(f"{tmp_path}/warned").count() == 6
        assert rows(spark.read.parquet(f"{tmp_path}/dropped")) == [("a", 1), ("d", 4)]
        for name in ("warned", "dropped"):
            assert counts.total(name) == {"rows": 6, "key": 2, "positive": 3} and len(counts.batches[name]) == 2
        spark.streams.addListener(strict)
        run("warn", strict, "strict")
        assert strict.stopped == {"strict": "positive"}
    finally:
        spark.streams.removeListener(counts)
        spark.streams.removeListener(strict)


def test_gold_grows_by_batch(spark, tmp_path):
    rng = random.Random(6)
    data = poll_rows(rng, 900)
    readings = traffic_readings(spark.createDataFrame(data, POLLS), newest=("_file_arrival_time", "event_id")).persist()
    target = f"{tmp_path}/gold"
    part = lambda n: readings.filter(F.col("event_id") % 3 == n)
    for number in (0, 1, 1):  # a batch that runs again adds nothing
        merge_readings(part(number), number, target)
    source = f"{tmp_path}/in"
    add_file(part(2), source)
    gold_stream(spark.readStream.schema(readings.schema).parquet(source), target=f"{tmp_path}/other", checkpoint=f"{tmp_path}/cp").awaitTermination()
    merge_readings(part(2), 2, target)
    parts = read_merged(spark, target)
    assert rows(daily_from_parts(parts)) == rows(corridor_daily(readings))
    mine, exact = patterns_from_parts(parts), congestion_patterns(readings)
    percentiles = ("median_congestion_ratio", "p95_congestion_ratio")
    assert mine.columns == exact.columns
    assert rows(mine.drop(*percentiles)) == rows(exact.drop(*percentiles))
    other = read_merged(spark, f"{tmp_path}/other")
    assert rows(daily_from_parts(other)) == rows(corridor_daily(part(2)))
    assert rows(other.drop("ratios")) == rows(reading_parts(part(2)).drop("ratios").select(*other.drop("ratios").columns))


def test_merged_percentiles_are_near(spark):
    values = spark.range(60_000).selectExpr(
        "'c' corridor_id", "'C' corridor_name", "1 day_of_week", "'weekday' day_type", "8 hour_of_day", "'midday' time_period",
        "CAST(id % 7 AS STRING) poll_date", "1 + (id * 7919 % 60000) / 60000D congestion_ratio", "300 duration_seconds",
        "300 static_duration_seconds", "10 distance_meters", "'light' congestion_severity",
    )
    parts = reading_parts(values.filter("congestion_ratio < 1.3")).unionByName(reading_parts(values.filter("congestion_ratio >= 1.3")))
    found = patterns_from_parts(merge_parts(parts)).first()
    assert abs(found["median_congestion_ratio"] - 1.5) < 0.007 and abs(found["p95_congestion_ratio"] - 1.95) < 0.007
    assert found["num_observations"] == 60_000


def test_distinct_sketches_add_up(spark):
    rows_ = spark.range(90_000).selectExpr("id % 3 AS route", "id % 10 AS day", "CAST(id % 30000 AS STRING) AS trip_id", "id % 50 AS stop_id")
    rows_ = rows_.unionByName(spark.sql("SELECT 0L AS route, 0L AS day, CAST(NULL AS STRING) AS trip_id, CAST(NULL AS BIGINT) AS stop_id"))
    columns = ["trip_id", "stop_id"]
    by_day = distinct_sketches(rows_, ["route", "day"], columns)
    found = {r["route"]: r for r in distinct_counts(merge_sketches(by_day, ["route"], columns), columns).collect()}
    for r in rows_.groupBy("route").agg(*[F.count_distinct(c).alias(c) for c in columns]).collect():
        assert abs(found[r["route"]]["trip_id"] - r["trip_id"]) <= 0.02 * r["trip_id"]
        assert found[r["route"]]["stop_id"] == r["stop_id"]


def test_quarter_hours_with_watermark(spark, tmp_path):
    source = f"{tmp_path}/in"
    schema = "polled_at TIMESTAMP, congestion_ratio DOUBLE"
    at = ["2024-01-01 08:01", "2024-01-01 08:14", "2024-01-01 08:16", "2024-01-01 10:00"]
    add_file(
        spark.createDataFrame([(a, 1.5) for a in at], "a STRING, congestion_ratio DOUBLE").select(
            F.col("a").cast("timestamp").alias("polled_at"), "congestion_ratio"
        ),
        source,
    )
    stream = spark.readStream.schema(schema).parquet(source).withWatermark("polled_at", "30 minutes")
    run_stream(quarter_hour_readings(stream), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert rows(stored.select("cache_key", "readings")) == [("8_2_q0", 2), ("8_2_q15", 1)]


def test_refresh_touches_only_given_days(spark, tmp_path):
    target = f"{tmp_path}/daily"

    def summarize(df):
        return df.groupBy(F.col("poll_date").alias("report_date")).agg(F.sum("v").alias("v"))

    def readings(values):
        return spark.createDataFrame(values, "poll_date STRING, v LONG")

    both = readings([("2024-01-01", 1), ("2024-01-02", 2)])
    refresh_days(both, both, summarize, target)
    changed = readings([("2024-01-01", 100), ("2024-01-02", 200)])
    refresh_days(changed, changed.filter("poll_date = '2024-01-02'"), summarize, target)
    assert sorted(r["v"] for r in spark.read.parquet(target).collect()) == [1, 200]
    gone = readings([("2024-01-01", 1)])
    refresh_days(gone, both.filter("poll_date = '2024-01-02'"), summarize, target)
    assert sorted(r["v"] for r in spark.read.parquet(target).collect()) == [1]
