import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from headway.functions.responses import decode_polyline
from headway.operators.latest import latest_snapshot
from headway.operators.quality import STOP_KEY, expect
from headway.operators.schedule import serving_stop_times
from headway.operators.shapes import polylines, route_polylines
from headway.plans.corridors import corridors_from_shapes, corridors_from_waypoints
from headway.plans.schedule import route_segments, scheduled_times
from headway.plans.segments import traffic_segments
from headway.sources.corridor_poll import CorridorPollSource, poll_options
from headway.sources.gtfs import (
    found_snapshots,
    ingest_snapshots,
    read_bronze,
    read_gtfs,
    read_ingested,
    scan_snapshots,
    stream_snapshots,
)
from headway.sources.places import read_box, save_by_place, z_order
from headway.sources.tables import publish_serving, read_serving, serving_editions
from headway.sources.traffic import (
    append_poll_json,
    corridor_records,
    export_corridors,
    export_waypoints,
    read_corridors,
    read_traffic,
    read_waypoints,
    stream_traffic,
)
from headway.streaming.tables import run_stream

CORRIDORS = [
    {
        "corridor_id": "corridor_01", "corridor_name": "One", "corridor_type": "arterial",
        "zone": "east", "speed_limit_kmh": 50, "num_lanes": 4,
        "origin": {"lat": 49.25, "lng": -123.06}, "destination": {"lat": 49.26, "lng": -123.07},
    }
]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)


@pytest.fixture
def feed(tmp_path):
    root = f"{tmp_path}/feed"
    put(f"{root}/2024-01-05/stops.txt",
        "stop_id,stop_name,stop_lat,stop_lon\nS1,One,49.1,-123.1\nS2,Two,bad,-123.2\n")
    # A later snapshot with other column order and an additional known column.
    put(f"{root}/2024-01-12/stops.txt",
        "stop_name,stop_id,stop_lon,stop_lat,zone_id\nUno,S1,-123.1,49.1,Z\n")
    put(f"{root}/2024-01-05/routes.txt", "route_id,route_short_name,route_type\nR1,007,3\n")
    put(f"{root}/2024-01-05/notes.txt", "x\n1\n")
    return root


def test_read_by_header_name(spark, feed):
    rows = {r["stop_id"]: r for r in read_gtfs(spark, feed, "stops", "2024-01-05").collect()}
    assert rows["S1"]["stop_lat"] == 49.1 and rows["S2"]["stop_lat"] is None
    late = read_gtfs(spark, feed, "stops", "2024-01-12").first()
    assert (late["stop_id"], late["stop_lat"], late["zone_id"], late["feed_date"]) == (
        "S1", 49.1, "Z", "2024-01-12"
    )


def test_ingest_is_incremental_and_isolates_errors(spark, feed, tmp_path, monkeypatch):
    target = f"{tmp_path}/loaded"
    assert found_snapshots(spark, feed).count() == 3
    first = ingest_snapshots(spark, feed, target)
    assert {(i.table, i.feed_date, i.error) for i in first} == {
        ("stops", "2024-01-05", None), ("stops", "2024-01-12", None), ("routes", "2024-01-05", None)
    }
    assert ingest_snapshots(spark, feed, target) == []
    put(f"{feed}/2024-01-19/stops.txt", "stop_id\nS1\n")

    def broken_stops(spark, root, table, date):
        if table == "stops":
            raise OSError("unreadable")
        return read_gtfs(spark, root, table, date)

    monkeypatch.setattr("headway.sources.gtfs.read_gtfs", broken_stops)
    put(f"{feed}/2024-01-19/routes.txt", "route_id,route_short_name,route_type\nR1,007,3\n")
    again = ingest_snapshots(spark, feed, target)
    assert {i.table: i.error is None for i in again} == {"stops": False, "routes": True}
    stops = read_ingested(spark, target, "stops")
    assert stops.count() == 3
    assert {r[0] for r in stops.select("feed_date").distinct().collect()} == {
        "2024-01-05", "2024-01-12"
    }


def test_bronze_batch_and_stream(spark, feed, tmp_path):
    put(f"{feed}/2024-01-12/routes.txt", "route_id,route_short_name,route_type\nR1,7,3\nR2,8,1\n")
    batch = scan_snapshots(spark, feed, "routes")
    assert sorted((r["gtfs_snapshot_date"], r["route_id"], r["_source_file"]) for r in batch.collect()) == [
        ("2024-01-05", "R1", "routes.txt"), ("2024-01-12", "R1", "routes.txt"),
        ("2024-01-12", "R2", "routes.txt"),
    ]
    target, checkpoint = f"{tmp_path}/bronze", f"{tmp_path}/cp"
    for _ in range(2):  # the second run finds nothing new
        stream_snapshots(spark, feed, "routes", target, checkpoint, max_files_per_trigger=1).awaitTermination()
        assert read_bronze(spark, target, "routes").count() == 3
    put(f"{feed}/2024-01-19/routes.txt", "route_id,route_short_name,route_type\nR3,9,4\n")
    put(f"{feed}/notes/routes.txt", "route_id,route_short_name,route_type\nR4,9,4\n")
    put(f"{feed}/2024-01-20/routes.txt", "")
    stream_snapshots(spark, feed, "routes", target, checkpoint).awaitTermination()
    stored = read_bronze(spark, target, "routes")
    assert stored.count() == 4 and stored.schema.simpleString() == batch.schema.simpleString()


def test_large_files_are_split(spark, tmp_path):
    """A stream's file goes through many tasks, and its rows are those of the batch scan."""
    root, target = f"{tmp_path}/feed", f"{tmp_path}/bronze"
    lines = [f'{i},"Stop, {i}",{49 + i / 1e5},-123.1' for i in range(20_000)]
    put(f"{root}/2024-01-05/stops.txt", "\n".join(["stop_id,stop_name,stop_lat,stop_lon", *lines]))
    put(f"{root}/2024-01-12/stops.txt", "\n".join(["stop_lon,stop_id,zone_id", *[f"-123,{i},z" for i in range(5000)]]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        stream_snapshots(spark, root, "stops", target, f"{tmp_path}/cp").awaitTermination()
        one = spark.read.option("header", True).csv(f"{root}/2024-01-05/stops.txt")
        assert one.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len([f for f in os.listdir(f"{target}/gtfs_snapshot_date=2024-01-05") if f.endswith(".parquet")]) > 4
    batch, stored = scan_snapshots(spark, root, "stops"), read_bronze(spark, target, "stops")
    assert stored.count() == 25_000 and stored.exceptAll(batch).isEmpty() and batch.exceptAll(stored).isEmpty()


def test_every_file_by_its_own_header(spark, tmp_path):
    """Columns in other order, added, missing and quoted, in batch and stream."""
    root = f"{tmp_path}/feed"
    put(f"{root}/2024-01-05/routes.txt", "route_id,route_short_name,route_type\nR1,007,3\n")
    put(f"{root}/2024-01-12/routes.txt",
        'route_type,route_id,route_long_name,route_short_name\n3,A,"Main, North",7\n')
    put(f"{root}/2024-01-19/routes.txt", '\ufeff"route_id","unheard_of"\nB,x\n')
    batch = scan_snapshots(spark, root, "routes")
    known = ["route_id", "route_short_name", "route_long_name", "route_type", "gtfs_snapshot_date"]
    expected = [
        ("A", "7", "Main, North", 3, "2024-01-12"), ("B", None, None, None, "2024-01-19"),
        ("R1", "007", None, 3, "2024-01-05"),
    ]
    assert sorted(tuple(r) for r in batch.select(*known).collect()) == expected
    target = f"{tmp_path}/bronze"
    stream_snapshots(spark, root, "routes", target, f"{tmp_path}/cp").awaitTermination()
    stored = read_bronze(spark, target, "routes")
    assert sorted(map(str, stored.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    newest = latest_snapshot(stored)
    assert [r["route_id"] for r in newest.collect()] == ["B"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gtfs_snapshot_date" in plan


def test_plans_take_the_newest_snapshot(spark):
    points = spark.sql("""
        SELECT 's' shape_id, CAST(i AS INT) shape_pt_sequence, 49 + i / 10D + d shape_pt_lat, -123D shape_pt_lon,
               concat('2024-01-0', d + 1) gtfs_snapshot_date
        FROM (SELECT explode(sequence(0, 20)) i), (SELECT explode(array(0, 1)) d)""")
    trips = spark.sql("SELECT 't' trip_id, 'r' route_id, 's' shape_id, d gtfs_snapshot_date FROM VALUES ('2024-01-01'), ('2024-01-02') AS v(d)")
    routes = spark.sql("""
        SELECT r route_id, '99' route_short_name, concat('Line ', r) route_long_name, 3 route_type, '' route_color
        FROM VALUES ('r'), ('q') AS v(r)""")
    found = route_segments(points, trips, routes).collect()
    assert sorted(r["origin_lat"] for r in found) == [50.0, 51.0]
    assert [len(r["coordinates"]) for r in route_polylines(points, trips, routes).collect()] == [21]
    both = trips.unionByName(trips.withColumns({"trip_id": F.lit("u"), "route_id": F.lit("q")}))
    ids = [r["corridor_id"] for r in corridors_from_shapes(points, both, routes).collect()]
    assert sorted(ids) == ["route_99_seg_1", "route_99_seg_2", "route_99_seg_3"]
    times = spark.sql("""
        SELECT 't' trip_id, concat('0', h, ':00:00') arrival_time, '09:00:00' departure_time, 'a' stop_id, 1 stop_sequence,
               d gtfs_snapshot_date FROM VALUES (7, '2024-01-01'), (8, '2024-01-02') AS v(h, d)""")
    assert [r["arrival_time"] for r in serving_stop_times(times, trips, routes).collect()] == ["08:00:00"]


def test_one_row_for_a_long_shape(spark):
    shape = spark.range(10_001).select(
        F.lit("s").alias("shape_id"), F.col("id").cast("int").alias("shape_pt_sequence"),
        F.lit(49.0).alias("shape_pt_lat"), F.lit(-123.0).alias("shape_pt_lon"),
    )
    assert [len(r["coordinates"]) for r in polylines(shape).collect()] == [10_001]


def test_corridor_and_waypoint_files_round_trip(spark, tmp_path):
    listed = [
        {**CORRIDORS[0], "corridor_id": f"c{i}", "origin": {"lat": 49.0 + i, "lng": -123.0}} for i in range(5)
    ]
    path = f"{tmp_path}/list"
    export_corridors(corridor_records(spark, json=json.dumps(listed)).repartition(3), path)
    back = read_corridors(spark, path)
    assert sorted(r["corridor_id"] for r in back.collect()) == [f"c{i}" for i in range(5)]
    options = poll_options(spark, path, transport="tests.transports:scripted")
    spark.dataSource.register(CorridorPollSource)
    polled = spark.read.format("corridor_poll").options(**options).load()
    assert {r["corridor_id"]: r["origin_lat"] for r in polled.collect()} == {f"c{i}": 49.0 + i for i in range(5)}
    segments = spark.sql("""
        SELECT 's' shape_id, 49 + i / 50D origin_lat, -123D origin_lon, 49 + (i + 1) / 50D dest_lat, -123D dest_lon,
               CAST(i * 10 AS INT) shape_pt_sequence, '7' route_short_name FROM (SELECT explode(sequence(0, 8)) i)""")
    routes = spark.sql("SELECT 'r7' route_id, '7' route_short_name, 'Seven' route_long_name, 3 route_type")
    export_waypoints(segments, f"{tmp_path}/w")
    found = corridors_from_waypoints(read_waypoints(spark, f"{tmp_path}/w"), routes).orderBy("corridor_id").collect()
    assert [(r["corridor_id"], r["origin"]["lat"]) for r in found] == [
        ("route_7_seg_1", 49.0), ("route_7_seg_2", 49.06), ("route_7_seg_3", 49.12)
    ]


def test_bad_polylines_give_no_points(spark):
    texts = spark.createDataFrame([("_p~iF~ps|U",), ("_p~iFé",), ("",), (None,), ("with blank",)], "t STRING")
    points = [r["p"] for r in texts.select(decode_polyline("t").alias("p")).collect()]
    assert points[0]["lat"] == [38.5] and points[2]["lat"] == [] and points[1] is points[3] is points[4] is None


def test_traffic_files(spark, tmp_path):
    path = f"{tmp_path}/polls"
    poll = spark.sql("""
        SELECT 'c1' corridor_id, 'C' corridor_name, 1D origin_lat, 1D origin_lng, 1D dest_lat,
               1D dest_lng, 10 duration_seconds, 8 static_duration_seconds, 5 distance_meters,
               1.25D congestion_ratio, '{}' api_response_json, timestamp'2024-01-01' polled_at""")
    append_poll_json(poll, path)
    append_poll_json(poll.withColumn("corridor_id", F.lit("c2")), path)
    rows = read_traffic(spark, path).collect()
    assert sorted(r["corridor_id"] for r in rows) == ["c1", "c2"]
    assert all(r["_file_arrival_time"] and r["_source_file"].startswith("part-") for r in rows)
    run_stream(stream_traffic(spark, path), f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_corridor_lists(spark, tmp_path):
    put(f"{tmp_path}/corridors.json", json.dumps(CORRIDORS, indent=2))
    from_file = read_corridors(spark, path=f"{tmp_path}/corridors.json")
    inline = read_corridors(spark, json=json.dumps(CORRIDORS))
    assert from_file.collect() == inline.collect()
    assert from_file.first()["dest_lng"] == -123.07
    with pytest.raises(ValueError):
        read_corridors(spark)


def test_exports(spark, tmp_path):
    segments = spark.sql("""
        SELECT 's' shape_id, 1D origin_lat, 2D origin_lon, 3D dest_lat, 4D dest_lon,
               '007' route_short_name, 10 shape_pt_sequence""")
    export_waypoints(segments, f"{tmp_path}/w")
    assert spark.read.json(f"{tmp_path}/w").first()["route_name"] == "007"
    corridors = spark.sql("SELECT 'c' corridor_id, struct(1D AS lat, 2D AS lng) origin")
    export_corridors(corridors, f"{tmp_path}/c")
    assert spark.read.json(f"{tmp_path}/c").first()["origin"]["lng"] == 2.0
    lines = spark.sql("SELECT 's' shape_id, array(array(1D, 2D)) coordinates")
    stops = spark.sql("SELECT 'x' stop_id, 'X' stop_name, 1D stop_lat, 2D stop_lon, 0 location_type")
    publish_serving(lines, stops, segments, f"{tmp_path}/serving", "2024-01-12")
    assert read_serving(spark, f"{tmp_path}/serving")["routes"].first()["coordinates"] == "[[1.0,2.0]]"


def test_serving_tables_change_as_one(spark, tmp_path):
    path = f"{tmp_path}/serving"

    def publish(n, date, broken=False):
        lines = spark.sql(f"SELECT '{n}' shape_id, array(array(1D, 2D)) coordinates")
        stops = spark.sql(f"SELECT '{n}' stop_id, 'X' stop_name, 1D stop_lat, 2D stop_lon, 0 location_type")
        segments = spark.sql(f"""
            SELECT '{n}' shape_id, 1D origin_lat, 2D origin_lon, 3D dest_lat, 4D dest_lon,
                   {"raise_error('x')" if broken else "'007'"} route_short_name""")
        publish_serving(lines, stops, segments, path, date)

    def seen(tables):
        return {name: df.first()[0] for name, df in tables.items()}

    publish(1, "2024-01-05")
    reader = read_serving(spark, path)
    publish(2, "2024-01-12")
    assert set(seen(reader).values()) == {"1"} and set(seen(read_serving(spark, path)).values()) == {"2"}
    with pytest.raises(Exception, match="x"):
        publish(3, "2024-01-19", broken=True)
    assert set(seen(read_serving(spark, path)).values()) == {"2"}
    publish(4, "2024-01-05")  # an older feed that is published again is not the newest
    assert set(seen(read_serving(spark, path)).values()) == {"2"}
    publish(5, "2024-01-12")
    assert set(seen(read_serving(spark, path)).values()) == {"5"}
    assert len(serving_editions(spark, path)) == 4
    assert set(seen(read_serving(spark, path, serving_editions(spark, path)[1])).values()) == {"2"}


def test_tables_by_place(spark, tmp_path):
    stops = spark.range(4000).selectExpr(
        "CAST(id AS STRING) stop_id", "48.7D + (id % 63) * 0.011D stop_lat", "-123.4D + (id % 59) * 0.013D stop_lon"
    ).unionByName(spark.sql("SELECT 'none' stop_id, CAST(NULL AS DOUBLE) stop_lat, 1D stop_lon"))
    path, box = f"{tmp_path}/stops", (49.0, -123.1, 49.08, -123.0)
    save_by_place(stops, path, "stop_lat", "stop_lon")
    found = read_box(spark, path, "stop_lat", "stop_lon", box)
    every = spark.read.parquet(path)
    inside = stops.filter("stop_lat BETWEEN 49.0 AND 49.08 AND stop_lon BETWEEN -123.1 AND -123.0")
    assert sorted(found.collect()) == sorted(inside.collect()) and found.count() > 0
    assert every.count() == 4001
    scan = found._jdf.queryExecution().sparkPlan().collectLeaves().apply(0)
    assert 0 < scan.selectedPartitions().totalNumberOfFiles() <= len(every.inputFiles()) / 8
    whole = read_box(spark, path, "stop_lat", "stop_lon", (-90.0, -180.0, 90.0, 180.0))
    assert whole.count() == 4000


def test_z_order_takes_turns(spark):
    points = spark.range(64).selectExpr("id", "(id % 8 + 0.5D) / 8 AS lon", "(FLOOR(id / 8) + 0.5D) / 8 AS lat")
    for r in points.withColumn("z", z_order(F.col("lat"), F.col("lon"), 1.0, 3)).collect():
        x, y = r["id"] % 8, r["id"] // 8
        assert r["z"] == sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(3))


def test_expectations(spark):
    stops = spark.createDataFrame([("a", 49.0), (None, 49.0), ("b", 60.0)], "stop_id STRING, stop_lat DOUBLE")
    assert expect(stops, STOP_KEY).count() == 2
    seen = Observation("rules")
    warned = expect(stops, {"area": "stop_lat BETWEEN 48 AND 50", **STOP_KEY}, "warn", observation=seen)
    assert warned.count() == 3 and seen.get == {"area": 1, "stop_id_not_null": 1}
    assert expect(stops.filter("stop_id IS NOT NULL"), STOP_KEY, "fail").count() == 2
    with pytest.raises(Exception, match="expectation failed: stop_id_not_null"):
        expect(stops, STOP_KEY, "fail").collect()


def test_stops_with_history_do_not_multiply_segments(spark):
    times = spark.sql("""
        SELECT 't' trip_id, 's1' stop_id, 1 stop_sequence, '08:00:00' arrival_time,
               '08:00:30' departure_time, CAST(NULL AS DOUBLE) shape_dist_traveled, d gtfs_snapshot_date
        FROM VALUES ('2024-01-05'), ('2024-01-12') AS v(d)
        UNION ALL SELECT 't', 's2', 5, '08:05:00', '08:05:10', 0.4D, d
        FROM VALUES ('2024-01-05'), ('2024-01-12') AS v(d)""")
    trips = spark.sql("""
        SELECT 't' trip_id, 'r' route_id, 'h' trip_headsign, 0 direction_id, 'x' service_id,
               '2024-01-12' gtfs_snapshot_date""")
    routes = spark.sql("SELECT 'r' route_id, '007' route_short_name, 'L' route_long_name, 3 route_type")
    stops = spark.sql("SELECT 's1' stop_id, 'One' stop_name, 1D stop_lat, 2D stop_lon")
    rows = scheduled_times(times, trips, routes, stops).collect()
    assert len(rows) == 1
    assert (rows[0]["scheduled_segment_seconds"], rows[0]["segment_distance_km"],
            rows[0]["dest_stop_name"], rows[0]["route_type"]) == (270, 0.4, None, "bus")


@pytest.mark.parametrize(
    ("speeds", "level"),
    [
        (["TRAFFIC_JAM"] * 4 + ["NORMAL"] * 6, "HIGH"),
        (["SLOW"] * 4 + ["NORMAL"] * 6, "MEDIUM"),
        (["SLOW"] * 3 + ["NORMAL"] * 7, "LOW"),
        (["TRAFFIC_JAM"] * 3 + ["SLOW"] * 3 + ["NORMAL"] * 4, "LOW"),
    ],
)
def test_response_levels(spark, speeds, level):
    readings = [
        {"startPolylinePointIndex": i, "endPolylinePointIndex": i + 1, "speed": s}
        for i, s in enumerate(speeds)
    ]
    answer = {
        "routes": [
            {
                "duration": "60s", "distanceMeters": 5,
                "polyline": {"encodedPolyline": "_p~iF~ps|U_ulLnnqC_mqNvxq`@"},
                "travelAdvisory": {"speedReadingIntervals": readings},
            }
        ]
    }
    responses = spark.createDataFrame(
        [(1.0, 2.0, 3.0, 4.0, json.dumps(answer))],
        "origin_lat DOUBLE, origin_lon DOUBLE, dest_lat DOUBLE, dest_lon DOUBLE, api_response_json STRING",
    )
    rows = traffic_segments(responses).orderBy("interval").collect()
    assert [r["level"] for r in rows] == [level] * 10
    assert (rows[0]["start_lat"], rows[0]["end_lat"]) == (38.5, 40.7)
    # Past the end of the polyline there is no point, never (0, 0).
    assert (rows[2]["start_lat"], rows[2]["end_lat"]) == (43.252, 43.252)
    assert rows[3]["start_lat"] is None and rows[3]["end_lat"] is None
