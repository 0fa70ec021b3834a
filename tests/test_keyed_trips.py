"""Trips by state for each vehicle: equal to the batch after each file, over restarts and failures, at the cost of the events."""

import json
import os
import random
import time

import numpy as np
import pytest
from test_trips import CASES, TRIP_SCHEMA, at, engine, place, seen, trip, world  # noqa: F401

from waymill.sources.sinks import latest_version, versions
from waymill.streaming import keyed
from waymill.streaming.trips import EVENT_SCHEMA, next_trips


def rows(df) -> list[tuple]:
    return sorted((r.vehicle_id, r.geometry, r.start_at, r.end_at, r.start_location, r.end_location) for r in df.collect())


def batch_after(spark, world, before, events):
    out = next_trips(spark.createDataFrame(events, EVENT_SCHEMA), world[0], before, world[1])
    return spark.createDataFrame(out.collect(), TRIP_SCHEMA)


class Stream:
    def __init__(self, spark, world, path, start):
        self.spark, self.world, self.start = spark, world, start
        self.folder, self.table, self.checkpoint = path / "in", str(path / "trips"), str(path / "checkpoint")
        self.folder.mkdir()
        self.files = 0

    def put(self, events):
        (self.folder / f"{self.files:03d}.json").write_text(json.dumps(events))
        self.files += 1

    def run(self, **settings):
        keyed.run_keyed_trips(self.spark, str(self.folder), self.table, self.checkpoint, *self.world, self.start, **settings).awaitTermination()

    def trips(self):
        return keyed.keyed_trip_table(self.spark, self.table)


def test_golden_cases_in_a_row_each_after_a_restart(spark, world, tmp_path):
    start = spark.createDataFrame([trip("v1", "LINESTRING(0 0,0 1)", "10:00", "10:01"), trip("v9", "LINESTRING(0 0,0 1)", "10:00", "10:01")], TRIP_SCHEMA)
    stream, batch = Stream(spark, world, tmp_path, start), start
    for case in sorted(CASES):
        stream.put(CASES[case][1])
        stream.run()
        batch = batch_after(spark, world, batch, CASES[case][1])
        assert rows(stream.trips()) == rows(batch), case
    keyed.compacted(spark, stream.table)
    assert rows(stream.trips()) == rows(batch)
    stream.put([place("v3", 9, 9, "20:00")])
    stream.run()
    assert rows(stream.trips()) == rows(batch_after(spark, world, batch, [place("v3", 9, 9, "20:00")]))


@pytest.mark.parametrize("case", ["old_point", "live"])
def test_golden_case_from_its_stored_trips(spark, world, tmp_path, case):
    stored, events, want = CASES[case]
    stream = Stream(spark, world, tmp_path, spark.createDataFrame(stored, TRIP_SCHEMA))
    stream.put(events)
    stream.run()
    assert seen(stream.trips()) == sorted((v, g, at(s), at(e)) for v, g, s, e in want)


def test_several_files_are_batches_of_their_own(spark, world, tmp_path):
    none = spark.createDataFrame([], TRIP_SCHEMA)
    stream, batch = Stream(spark, world, tmp_path, none), none
    for case in ("first_trip", "update_trip", "mixed_trip"):
        stream.put(CASES[case][1])
        os.utime(stream.folder / f"{stream.files - 1:03d}.json", (1e9 + stream.files, 1e9 + stream.files))
        batch = batch_after(spark, world, batch, CASES[case][1])
    stream.run(files_per_batch=1)
    assert len(versions(spark, f"{stream.table}/pieces")) == 3 and rows(stream.trips()) == rows(batch)


def test_a_batch_that_fails_runs_again_from_the_states_before_it(spark, world, tmp_path, monkeypatch):
    none = spark.createDataFrame([], TRIP_SCHEMA)
    stream = Stream(spark, world, tmp_path, none)
    stream.put(CASES["first_trip"][1])
    stream.run()
    stream.put(CASES["update_trip"][1])
    write = keyed.replace

    def broken(df, table, number):
        write(df, table, number)
        raise OSError("lost after the pieces were written, before the batch counts")

    monkeypatch.setattr(keyed, "replace", broken)
    with pytest.raises(Exception, match="lost after"):
        stream.run()
    monkeypatch.setattr(keyed, "replace", write)
    stream.run()
    batch = batch_after(spark, world, batch_after(spark, world, none, CASES["first_trip"][1]), CASES["update_trip"][1])
    assert rows(stream.trips()) == rows(batch) and len(versions(spark, f"{stream.table}/pieces")) == 2
    before = latest_version(spark, f"{stream.table}/pieces")
    stream.run()  # nothing new: nothing is read or written again
    assert latest_version(spark, f"{stream.table}/pieces") == before


def drive(rng, vehicle, minutes, hour):
    out, lon, lat = [], rng.randrange(4), rng.randrange(4)
    for m in range(minutes):
        lon, lat = lon + rng.choice([0, 0.00001, 0.01]), lat + rng.choice([0, 0.00001, 0.01])
        if rng.random() < 0.7:
            out.append(place(vehicle, round(lon, 5), round(lat, 5), f"{hour:02d}:{m:02d}"))
        if rng.random() < 0.1:
            out.append(engine(vehicle, rng.choice(["on", "off"]), f"{hour:02d}:{m:02d}"))
    return out


def test_random_drives_equal_the_batch(spark, world, tmp_path):
    rng = random.Random(4)
    none = spark.createDataFrame([], TRIP_SCHEMA)
    stream, batch = Stream(spark, world, tmp_path, none), none
    for hour in (8, 9, 9, 12):
        events = [e for v in ("v1", "v2", "v3") for e in drive(rng, v, 50, hour)]
        rng.shuffle(events)
        stream.put(events)
        stream.run()
        batch = batch_after(spark, world, batch, events)
        assert rows(stream.trips()) == rows(batch)


def test_a_batch_writes_its_events_not_the_history(spark, world, tmp_path):
    line = "LINESTRING(" + ",".join(f"{k % 90} {k % 45}" for k in range(3000)) + ")"
    history = [trip(f"old{k}", line, "01:00", "02:00") for k in range(300)] + [trip("v1", line, "01:00", "02:00")]
    stream = Stream(spark, world, tmp_path, spark.createDataFrame(history, TRIP_SCHEMA))
    stream.put([place("v1", 1, 1, "02:05"), place("v1", 1, 2, "02:06")])
    stream.run()
    size = lambda path: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))
    pieces = spark.read.parquet(latest_version(spark, f"{stream.table}/pieces"))
    assert pieces.count() == 1 and pieces.first().extends and len(pieces.first().points) == 2
    assert size(f"{stream.table}/pieces") < 20_000 and stream.trips().count() == 301
    assert [r.end_at for r in stream.trips().where("vehicle_id = 'v1'").collect()] == [at("02:06")]


def test_a_long_trip_is_folded_in_one_pass(spark):
    """Of n vertices n are read, not n for each of them."""
    n = 120_000
    piece = spark.range(1).selectExpr("'v1' AS vehicle_id", "false AS extends", "TIMESTAMP_NTZ '2024-01-01 08:00:00' AS start_at", "TIMESTAMP_NTZ '2024-01-01 09:00:00' AS end_at", f"transform(sequence(0, {n - 1}), i -> named_struct('lon', double(i div 2 % 90), 'lat', double(0))) AS points", "'a' AS start_location", "'b' AS end_location")
    began = time.time()
    got = keyed.folded(spark.createDataFrame([], TRIP_SCHEMA), piece).first()
    assert time.time() - began < 60
    assert got.geometry.count(",") == n // 2 - 1 and got.geometry.startswith("LINESTRING(0 0,1 0,2 0")


def test_a_vehicle_s_events_are_taken_in_columns():
    rng, n = np.random.default_rng(2), 1_000_000
    at, place = rng.integers(0, 10**12, n), rng.random(n) < 0.9
    engine = np.where(place, -1, rng.integers(0, 2, n)).astype("int8")
    lon, lat = np.where(rng.random(n) < 0.01, np.nan, rng.integers(0, 50, n) * 0.001), rng.integers(0, 20, n) * 0.00005
    began = time.time()
    last, pieces = keyed.advance(None, *keyed.driven(at, place, engine, lon, lat))
    assert time.time() - began < 5 and last.end_at == pieces[-1].end_at
    assert all(((p.lons[1:] != p.lons[:-1]) | (p.lats[1:] != p.lats[:-1])).all() for p in pieces)
