import json

import pytest

from headway.sources.corridor_poll import (
    CorridorPollSource,
    CorridorPollStreamReader,
    fetch_with_retry,
)
from headway.streaming.tables import run_stream
from tests.transports import http_error

CORRIDORS = json.dumps(
    [
        {
            "corridor_id": name, "corridor_name": name.title(),
            "origin": {"lat": 49.1, "lng": -123.1}, "destination": {"lat": 49.2, "lng": -123.2},
        }
        for name in ("good", "busy", "gone", "slow", "empty", "zero")
    ]
)
OPTIONS = {
    "corridors_json": CORRIDORS, "transport": "tests.transports:scripted",
    "initial_backoff": "0.01", "slices": "3",
}


@pytest.mark.parametrize(
    ("errors", "tries", "pauses", "answered"),
    [
        ([], 1, [], True),
        ([http_error(429)], 2, [1.0], True),
        ([http_error(503)] * 3, 4, [1.0, 2.0, 4.0], True),
        ([http_error(404)], 1, [], False),
        ([TimeoutError("t")] * 9, 4, [1.0, 2.0, 4.0], False),
        ([ValueError("bad")], 1, [], False),
    ],
)
def test_retry(errors, tries, pauses, answered):
    script, count, slept = list(errors), [0], []

    def fetch():
        count[0] += 1
        if script:
            raise script.pop(0)
        return "{}"

    answer = fetch_with_retry(fetch, sleep=slept.append)
    assert (count[0], slept, answer == "{}") == (tries, pauses, answered)
    assert answered or "error" in json.loads(answer)


def test_pauses_are_capped():
    slept = []

    def fetch():
        raise ConnectionError("down")

    fetch_with_retry(fetch, max_retries=7, sleep=slept.append)
    assert slept == [1.0, 2.0, 4.0, 8.0, 16.0, 30.0, 30.0]


def test_batch_poll(spark):
    spark.dataSource.register(CorridorPollSource)
    df = spark.read.format("corridor_poll").options(**OPTIONS).load()
    assert df.rdd.getNumPartitions() == 3
    rows = {r["corridor_id"]: r for r in df.collect()}
    assert len(rows) == 6 and len({r["polled_at"] for r in rows.values()}) == 1
    for name in ("good", "busy"):
        r = rows[name]
        assert (r["duration_seconds"], r["static_duration_seconds"], r["distance_meters"],
                r["congestion_ratio"]) == (130, 100, 900, 1.3)
    for name in ("gone", "slow"):
        assert '"error"' in rows[name]["api_response_json"]
        assert rows[name]["duration_seconds"] is None
    assert rows["empty"]["duration_seconds"] is None and '"error"' not in rows["empty"]["api_response_json"]
    assert (rows["zero"]["duration_seconds"], rows["zero"]["congestion_ratio"]) == (5, None)


def test_missing_corridors():
    with pytest.raises(ValueError):
        CorridorPollStreamReader({"transport": "x:y"})


def test_stream_offsets_follow_the_clock():
    reader = CorridorPollStreamReader({**OPTIONS, "poll_interval_seconds": "900"})
    first, latest = reader.initialOffset(), reader.latestOffset()
    assert reader.latestOffset() == latest and latest["poll"] - first["poll"] in (1, 2)
    assert reader.partitions(latest, latest) == []
    parts = reader.partitions(first, latest)
    assert len(parts) == 3 and len({p.polled_at for p in parts}) == 1
    assert CorridorPollStreamReader({**OPTIONS}).latestOffset()["poll"] >= latest["poll"]


def test_stream_poll(spark, tmp_path):
    spark.dataSource.register(CorridorPollSource)
    stream = spark.readStream.format("corridor_poll").options(**OPTIONS).load()
    query = run_stream(stream, f"{tmp_path}/polls", f"{tmp_path}/cp", trigger="1 minute")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/polls").select("corridor_id").distinct().count() == 6
