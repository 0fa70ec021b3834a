"""The eight replayable trip cases, on synthetic vehicles v1 to v3, as a batch and as a stream."""

import json
from datetime import datetime

import pytest

from waymill.sources.sinks import latest_version
from waymill.streaming import stream
from waymill.streaming.trips import EVENT_SCHEMA, TRIP, next_trips

TRIP_SCHEMA = "vehicle_id string, geometry string, start_location string, end_location string, start_at timestamp_ntz, end_at timestamp_ntz"


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2025-01-01 {text if text.count(':') == 2 else text + ':00'}")


def place(v: str, lon: float, lat: float, time: str) -> dict:
    data = {"vehicle_location": {"coordinates": {"data": {"latitude": lat, "longitude": lon}, "timestamp": f"2025-01-01T{time if time.count(':') == 2 else time + ':00'}.000Z"}}}
    return {"vin": f"vin-{v}", "data": json.dumps(data), "capability": "vehicle_location"}


def engine(v: str, status: str, time: str) -> dict:
    data = {"engine": {"status": {"data": status, "timestamp": str(at(time))}}}
    return {"vin": f"vin-{v}", "data": json.dumps(data), "capability": "engine"}


def other(v: str, capability: str, key: str) -> dict:
    return {"vin": f"vin-{v}", "data": json.dumps({capability: {key: {"data": 1, "timestamp": "2025-01-01 12:00:00"}}}), "capability": capability}


def trip(v: str, geometry: str, start: str, end: str) -> tuple:
    return (v, geometry, "kept", "kept", at(start), at(end))


L01 = "LINESTRING(0 0,0 1)"
NEW_V3 = [place("v3", 1, 1, "13:00"), place("v3", 2, 2, "13:01"), place("v3", 3, 3, "14:00")]
CASES = {
    "first_trip": ([], [place("v1", 0, 0, "12:00"), place("v1", 1, 1, "12:01"), place("v2", 0, 0, "12:00"), other("v1", "diagnostics", "odometer"), place("nobody", 0, 0, "12:00")], [("v1", "LINESTRING(0 0,1 1)", "12:00", "12:01"), ("v2", "POINT(0 0)", "12:00", "12:00")]),
    "new_trip": (
        [trip(v, "LINESTRING(0 0,0 0)", "12:00:00", "12:00:01") for v in ("v1", "v2", "v3")],
        [place("v1", 1, 1, "13:00"), place("v1", 2, 2, "13:01"), place("v1", 3, 3, "13:02"), place("v2", 1, 1, "13:00"), *NEW_V3],
        [(v, "LINESTRING(0 0,0 0)", "12:00:00", "12:00:01") for v in ("v1", "v2", "v3")]
        + [("v1", "LINESTRING(0 0,1 1,2 2,3 3)", "13:00", "13:02"), ("v2", "LINESTRING(0 0,1 1)", "13:00", "13:00"), ("v3", "LINESTRING(0 0,1 1,2 2)", "13:00", "13:01"), ("v3", "LINESTRING(2 2,3 3)", "14:00", "14:00")],
    ),
    "update_trip": ([trip(v, L01, "12:00", "12:01") for v in ("v1", "v2")], [place("v1", 1, 1, "12:02"), place("v2", 1, 1, "12:02"), place("v2", 2, 2, "12:03")], [("v1", "LINESTRING(0 0,0 1,1 1)", "12:00", "12:02"), ("v2", "LINESTRING(0 0,0 1,1 1,2 2)", "12:00", "12:03")]),
    "old_point": ([trip("v1", "LINESTRING(0 0,0 0)", "12:00", "12:05")], [place("v1", 1, 1, "11:00"), place("v1", 2, 2, "12:03"), place("v1", 3, 3, "12:06")], [("v1", "LINESTRING(0 0,3 3)", "12:00", "12:06")]),
    "noise_filtering": ([trip("v3", "LINESTRING(0 0,0 0)", "12:00:00", "12:00:01")], [place("v3", 0.00001 * k, 0.00001 * k, "12:02") for k in (1, 2, 3)], [("v3", "LINESTRING(0 0,0 0)", "12:00:00", "12:00:01")]),
    "mixed_trip": (
        [trip("v2", L01, "12:00", "12:01"), trip("v3", "LINESTRING(0 0,0 0)", "12:00:00", "12:00:01")],
        [place("v1", 0, 0, "12:00"), place("v1", 1, 1, "12:01"), place("v2", 1, 1, "12:02"), *NEW_V3],
        [("v1", "LINESTRING(0 0,1 1)", "12:00", "12:01"), ("v2", "LINESTRING(0 0,0 1,1 1)", "12:00", "12:02"), ("v3", "LINESTRING(0 0,0 0)", "12:00:00", "12:00:01"), ("v3", "LINESTRING(0 0,1 1,2 2)", "13:00", "13:01"), ("v3", "LINESTRING(2 2,3 3)", "14:00", "14:00")],
    ),
    "engine_off_trip": (
        [trip("v1", L01, "12:00", "12:01"), trip("v2", L01, "12:00", "12:01"), trip("v3", L01, "12:00:00", "12:00:01")],
        [engine("v1", "off", "12:02"), place("v1", 1, 1, "12:02"), place("v2", 1, 1, "12:02"), engine("v2", "off", "12:02:30"), place("v2", 2, 2, "12:03"), engine("v3", "on", "12:02"), place("v3", 3, 3, "12:03"), engine("v3", "off", "12:04:30"), place("v3", 4, 3, "12:05"), place("v3", 3, 4, "12:06"), engine("v3", "on", "12:07:30"), place("v3", 4, 4, "12:08")],
        [("v1", L01, "12:00", "12:01"), ("v2", "LINESTRING(0 0,0 1,1 1)", "12:00", "12:02"), ("v3", "LINESTRING(0 0,0 1,3 3,4 4)", "12:00:00", "12:08")],
    ),
    "live": ([trip("v1", "POINT(4.5 45.5)", "12:00", "12:00")], [place("v1", 4.50003, 45.50001, "12:01"), other("v1", "vehicle_location", "altitude"), other("v1", "vehicle_location", "heading"), other("v1", "race", "coordinates")], [("v1", "POINT(4.5 45.5)", "12:00", "12:00")]),
}


@pytest.fixture(scope="module")
def world(spark):
    vehicles = spark.createDataFrame([(v, f"vin-{v}") for v in ("v1", "v2", "v3")], "id string, vin string")
    spots = [(0, 0), (0, 1), (1, 1), (2, 2), (3, 3), (4, 4)]
    rows = [(str(k), "main street", "10000", "Town", f"POINT({x + 0.0001} {y})") for k, (x, y) in enumerate(spots)]
    rows += [("99", "far street", "10000", "Town", "POINT(0.002 0.002)"), ("98", "far street", "10000", "Town", "POINT(-0.003 0)")]
    return vehicles, spark.createDataFrame(rows, "number string, street string, postal_code string, city string, geom string")


def expected(case: str) -> list[tuple]:
    return sorted((v, g, at(s), at(e)) for v, g, s, e in CASES[case][2])


def seen(df) -> list[tuple]:
    return sorted((r.vehicle_id, r.geometry, r.start_at, r.end_at) for r in df.collect())


@pytest.mark.parametrize("case", sorted(CASES))
def test_batch(spark, world, case):
    stored, events, _ = CASES[case]
    out = next_trips(spark.createDataFrame(events, EVENT_SCHEMA), world[0], spark.createDataFrame(stored, TRIP_SCHEMA), world[1])
    assert out.columns == TRIP
    assert seen(out) == expected(case)


def test_locations_are_the_nearest_and_only_of_changed_trips(spark, world):
    stored, events, _ = CASES["mixed_trip"]
    out = next_trips(spark.createDataFrame(events, EVENT_SCHEMA), world[0], spark.createDataFrame(stored, TRIP_SCHEMA), world[1])
    found = {(r.vehicle_id, r.start_at): (r.start_location, r.end_location) for r in out.collect()}
    assert found["v1", at("12:00")] == ("0 main street 10000 Town", "2 main street 10000 Town")
    assert found["v2", at("12:00")] == ("0 main street 10000 Town", "2 main street 10000 Town")
    assert found["v3", at("12:00")] == ("kept", "kept")
    assert found["v3", at("14:00")] == ("3 main street 10000 Town", "4 main street 10000 Town")


def test_stream_equals_batch_after_each_file(spark, world, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "trips")
    folder.mkdir()
    none = spark.createDataFrame([], TRIP_SCHEMA)
    batch = none
    for k, case in enumerate(("first_trip", "update_trip", "engine_off_trip")):
        events = CASES[case][1]
        (folder / f"{k}.json").write_text(json.dumps(events))
        stream.run_trips(spark, str(folder), table, str(tmp_path / "checkpoint"), *world, none).awaitTermination()
        batch = spark.createDataFrame(next_trips(spark.createDataFrame(events, EVENT_SCHEMA), world[0], batch, world[1]).collect(), TRIP_SCHEMA)
        assert seen(spark.read.parquet(latest_version(spark, table))) == seen(batch)


def test_all_cases_in_a_row_rewrite_only_touched_parts(spark, world, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "trips")
    folder.mkdir()
    start = spark.createDataFrame([trip("v1", L01, "10:00", "10:01"), trip("v9", L01, "10:00", "10:01")], TRIP_SCHEMA)
    batch, (untouched,) = start, {r.part for r in start.where("vehicle_id = 'v9'").select(stream.part_of().alias("part")).collect()}
    for k, case in enumerate(sorted(CASES)):
        events = CASES[case][1]
        (folder / f"{k}.json").write_text(json.dumps(events))
        stream.run_trips(spark, str(folder), table, str(tmp_path / "checkpoint"), *world, start).awaitTermination()
        batch = spark.createDataFrame(next_trips(spark.createDataFrame(events, EVENT_SCHEMA), world[0], batch, world[1]).collect(), TRIP_SCHEMA)
        assert seen(stream.trip_table(spark, table)) == seen(batch), case
    versions = stream._versions(spark, table)
    assert versions[untouched] == 0 and max(versions.values()) == len(CASES)


def test_empty_batch(spark, world):
    none = spark.createDataFrame([], TRIP_SCHEMA)
    assert next_trips(spark.createDataFrame([], EVENT_SCHEMA), world[0], none, world[1]).count() == 0
