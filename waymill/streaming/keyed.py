"""Trips from an event stream with a state for each vehicle: a batch costs what its events cost, whatever the history.

The state store keeps, for each vehicle, when its last trip began and ended and that trip's first and last
place. An arriving batch reads and writes the states of its own vehicles and appends what it found: new trips, and pieces
that extend a vehicle's last one. Nothing stored is read or rewritten. ``trip_table`` folds the pieces into trips
when they are read, ``compacted`` does so for good.

Rules and results are those of ``trips.next_trips`` applied to one batch after the other. Offsets, states and pieces go
together: a batch that runs again after a failure starts from the states before it and overwrites its own pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from waymill.operators.common import materialised
from waymill.operators.spatial import PlaceIndex, nearest_in
from waymill.sources.sinks import latest_version, replace, versions
from waymill.streaming.stream import event_files
from waymill.streaming.trips import GAP, NOISE_METRES, TRIP, TRIP_SCHEMA, address_index, geometry_text, last_trips, typed_events, vertices, without_repeats

GAP_MICROS, RADIUS = int(GAP.split()[0]) * 60_000_000, 6_371_008.8
STATE = "start_at bigint, end_at bigint, first_lon double, first_lat double, lon double, lat double"
#: What the state processor takes of an event.
EVENT = {"at": "int64", "place": "bool", "engine": "int8", "lon": "float64", "lat": "float64"}
FOUND = "vehicle_id string, extends boolean, start_at bigint, end_at bigint, lons array<double>, lats array<double>, first_lon double, first_lat double, last_lon double, last_lat double"
PIECE = "vehicle_id string, extends boolean, start_at timestamp_ntz, end_at timestamp_ntz, points array<struct<lon:double,lat:double>>, start_location string, end_location string"


class Last(NamedTuple):
    """A vehicle's last trip: begin and end in microseconds, first and last place."""

    start_at: int
    end_at: int
    first_lon: float
    first_lat: float
    lon: float
    lat: float


class Piece(NamedTuple):
    """What a batch adds: to the last trip, or a new one. ``lons`` and ``lats`` are of the points to be added."""

    extends: bool
    start_at: int
    end_at: int
    lons: np.ndarray
    lats: np.ndarray
    first: tuple[float, float]
    last: tuple[float, float]


def metres(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """From each point to the next."""
    x, y = np.radians(lon), np.radians(lat)
    half = np.sin(np.diff(y) / 2) ** 2 + np.cos(y[:-1]) * np.cos(y[1:]) * np.sin(np.diff(x) / 2) ** 2
    return 2 * RADIUS * np.arcsin(np.sqrt(np.minimum(half, 1.0)))


def stored(x: float) -> float:
    """A coordinate as the text of a geometry keeps it."""
    return float(Decimal(repr(float(x))).quantize(Decimal("1e-7"), ROUND_HALF_UP))


def driven(at: np.ndarray, place: np.ndarray, engine: np.ndarray, lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Times and places while the last known engine status is on or unknown; an engine event comes first at its time.

    place: whether an event is of a place; engine: 1 on, 0 off, -1 none told; unknown coordinates are NaN.
    """
    known = lambda x: [np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf), ~np.isnan(x)]
    order = np.lexsort([*known(lat), *known(lon), place, at])
    at, place, engine, lon, lat = (x[order] for x in (at, place, engine, lon, lat))
    told = np.maximum.accumulate(np.where(engine >= 0, np.arange(len(at)), -1))
    on = (told < 0) | (engine[told] == 1)
    kept = place & on & ~np.isnan(lon) & ~np.isnan(lat)
    return at[kept], lon[kept], lat[kept]


def advance(last: Last | None, at: np.ndarray, lon: np.ndarray, lat: np.ndarray, gap: int = GAP_MICROS, noise: float = NOISE_METRES) -> tuple[Last | None, list[Piece]]:
    """The state after some points of a vehicle, and the pieces that they add.

    Points not after the last trip's end are late and go. That trip's end goes along, so gaps and small moves are judged
    against it; a later piece begins with the raw point before it. All points are taken in whole columns.
    """
    if last is not None:
        new = at > last.end_at
        at, lon, lat = at[new], lon[new], lat[new]
    order = np.lexsort([lat, lon, at])
    at, lon, lat = at[order], lon[order], lat[order]
    differs = lambda *cs: np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in cs])])[: len(cs[0])]
    once = differs(at, lon, lat)
    at, lon, lat = at[once], lon[once], lat[once]
    if last is not None:
        at, lon, lat = np.insert(at, 0, last.end_at), np.insert(lon, 0, last.lon), np.insert(lat, 0, last.lat)
    if not len(at):
        return last, []
    kept = np.flatnonzero(np.concatenate([[True], ~(metres(lon, lat) <= noise)]))
    groups = np.split(kept, np.flatnonzero(np.diff(at[kept]) > gap) + 1)
    pieces = []
    for n, group in enumerate(groups):
        extends = last is not None and n == 0
        if extends and len(group) == 1:
            continue
        line = np.insert(group, 0, group[0] - 1) if n else group
        xs, ys = lon[line], lat[line]
        own = differs(xs, ys)
        xs, ys, end = xs[own], ys[own], int(at[group[-1]])
        ends = (float(xs[0]), float(ys[0])), (float(xs[-1]), float(ys[-1]))
        if extends:
            pieces.append(Piece(True, last.start_at, end, xs[1:], ys[1:], (last.first_lon, last.first_lat), ends[1]))
        else:
            pieces.append(Piece(False, int(at[group[0]]), end, xs, ys, *ends))
    if pieces:
        p = pieces[-1]
        last = Last(p.start_at, p.end_at, *map(stored, p.first), *map(stored, p.last))
    return last, pieces


class TripProcessor(StatefulProcessor):
    """Holds each vehicle's last trip; forgets vehicles unseen for ``keep_ms`` if that is given."""

    def __init__(self, keep_ms: int | None = None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE, self.keep_ms)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        r = initialState.iloc[0]
        self.last.update((int(r.start_at), int(r.end_at), float(r.first_lon), float(r.first_lat), float(r.lon), float(r.lat)))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        parts = [[batch[c].to_numpy(t) for c, t in EVENT.items()] for batch in rows]
        before = Last(*self.last.get()) if self.last.exists() else None
        after, pieces = advance(before, *driven(*[np.concatenate(x) for x in zip(*parts)]))
        if pieces:
            self.last.update(tuple(after))
            out = [(key[0], p.extends, p.start_at, p.end_at, p.lons, p.lats, *p.first, *p.last) for p in pieces]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

    def close(self) -> None:
        pass


def time_micros(c: str) -> Column:
    """Microseconds of a wall clock time, whatever the session's time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', {c})")


def wall_time(c: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {c}, TIMESTAMP_NTZ '1970-01-01')")


def keyed_pieces(raw: DataFrame, vehicles: DataFrame, start: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """The pieces (``FOUND``) that a stream of raw events adds to the trips of ``start``."""
    known = typed_events(raw).join(vehicles.select(F.col("id").alias("vehicle_id"), "vin"), "vin")
    engine = F.when(F.col("status").isNull(), -1).otherwise((F.col("status") == "on").cast("int")).cast("byte")
    events = known.select("vehicle_id", time_micros("ts").alias("at"), (F.col("capability") == "vehicle_location").alias("place"), engine.alias("engine"), "lon", "lat")
    ends = last_trips(start).withColumn("v", vertices(F.col("geometry")))
    place = lambda k, name: [F.element_at("v", k)["lon"].alias(f"{name}lon"), F.element_at("v", k)["lat"].alias(f"{name}lat")]
    first = ends.select("vehicle_id", time_micros("start_at").alias("start_at"), time_micros("end_at").alias("end_at"), *place(1, "first_"), *place(-1, ""))
    grouped = events.groupBy("vehicle_id")
    return grouped.transformWithStateInPandas(TripProcessor(keep_ms), FOUND, "append", "processingTime" if keep_ms else "none", initialState=first.groupBy("vehicle_id"))


def placed(found: DataFrame, spots: PlaceIndex) -> DataFrame:
    """Pieces with the nearest addresses of their trip's first and their own last place."""
    line = F.transform(F.arrays_zip("lons", "lats"), lambda p: F.struct(p["lons"].alias("lon"), p["lats"].alias("lat")))
    own = materialised(found.withColumn("number", F.monotonically_increasing_id()))
    ends = own.select("number", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("first_lon").alias("lon"), F.col("first_lat").alias("lat")), F.struct(F.lit(1).alias("which"), F.col("last_lon").alias("lon"), F.col("last_lat").alias("lat")))).alias("e"))
    near = nearest_in(spots, ends.select(F.struct("number", "e.which").alias("id"), "e.lon", "e.lat"), "id", "lon", "lat")
    sides = near.groupBy("id.number").agg(*[F.max(F.when(F.col("id.which") == k, F.col("place"))).alias(c) for k, c in enumerate(("start_location", "end_location"))])
    return own.join(sides, "number", "left").select("vehicle_id", "extends", wall_time("start_at").alias("start_at"), wall_time("end_at").alias("end_at"), line.alias("points"), "start_location", "end_location")


def run_keyed_trips(spark: SparkSession, folder: str, table: str, checkpoint: str, vehicles: DataFrame, addresses: DataFrame, start: DataFrame, files_per_batch: int | None = None, keep_ms: int | None = None) -> StreamingQuery:
    """Processes all files there are, ``files_per_batch`` to a batch; the result begins with the trips of ``start``.

    A vehicle without events for ``keep_ms`` is forgotten: what comes later starts a new trip, and late events are not
    told from others. Without it states stay. Needs the RocksDB state store, which the query gets; the session's setting stays.
    """
    if latest_version(spark, f"{table}/whole") is None:
        replace(start.select(*TRIP), f"{table}/whole", 0)
    known, spots = materialised(vehicles), address_index(addresses)

    def step(batch: DataFrame, number: int) -> None:
        replace(placed(batch, spots), f"{table}/pieces", number)

    name, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    usual = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        found = keyed_pieces(event_files(spark, folder, files_per_batch), known, start, keep_ms)
        return found.writeStream.outputMode("append").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, usual) if usual else spark.conf.unset(name)


def _pieces(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame, int]:
    """The whole trips, the pieces since then, and the number up to which batches are in."""
    number, path = max(versions(spark, f"{table}/whole"))
    since = [(n, p) for n, p in versions(spark, f"{table}/pieces") if n >= number]
    pieces = spark.read.schema(PIECE).parquet(*[p for _, p in since]) if since else spark.createDataFrame([], PIECE)
    return spark.read.schema(TRIP_SCHEMA).parquet(path), pieces, max([number - 1, *(n for n, _ in since)]) + 1


def keyed_trip_table(spark: SparkSession, table: str) -> DataFrame:
    """All trips as of the last whole batch."""
    whole, pieces, _ = _pieces(spark, table)
    return folded(whole, pieces)


def folded(whole: DataFrame, pieces: DataFrame) -> DataFrame:
    """Trips with their pieces put in, in the order of time; only trips that have some are joined anew."""
    rows = F.array_sort(F.collect_list(F.struct("end_at", "points", "start_location", "end_location")))
    grown = pieces.groupBy("vehicle_id", "start_at").agg(rows.alias("rows")).withColumn("end", F.element_at("rows", -1))
    more = grown.select("vehicle_id", "start_at", F.flatten(F.col("rows.points")).alias("more"), F.col("end.end_at").alias("until"), F.col("end.start_location").alias("from_place"), F.col("end.end_location").alias("to_place"))
    met = whole.join(more, ["vehicle_id", "start_at"], "full_outer")
    before = F.when(F.col("geometry").isNull(), F.array().cast("array<struct<lon:double,lat:double>>")).otherwise(vertices(F.col("geometry")))
    new = F.col("until").isNotNull()
    line = geometry_text(without_repeats(F.concat(before, "more")))
    return met.withColumns({
        "geometry": F.when(new, line).otherwise(F.col("geometry")),
        "start_location": F.when(new, F.col("from_place")).otherwise(F.col("start_location")),
        "end_location": F.when(new, F.col("to_place")).otherwise(F.col("end_location")),
        "end_at": F.coalesce("until", "end_at"),
    }).select(*TRIP)


def compacted(spark: SparkSession, table: str) -> str:
    """Folds all pieces into the trips; readers go on from there. To be run while no batch does."""
    whole, pieces, number = _pieces(spark, table)
    return replace(folded(whole, pieces), f"{table}/whole", number)
