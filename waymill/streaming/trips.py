"""GPS events to trips: a pure DataFrame function of a batch of events and the stored trips.

The same function serves a batch table and each micro-batch of a stream. A trip is vehicle_id, geometry
(well-known text), start_location, end_location, start_at, end_at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.functions.standardise import coordinates, wall_clock
from waymill.operators.common import bound, materialised
from waymill.operators.dedupe import first_per_key
from waymill.operators.expect import has_only_key
from waymill.operators.spatial import PlaceIndex, nearest_in, place_index
from waymill.operators.timeseries import forward_fill, moved, sessions

GAP, NOISE_METRES = "10 minutes", 15.0
TRIP = ["vehicle_id", "geometry", "start_location", "end_location", "start_at", "end_at"]
TRIP_SCHEMA = "vehicle_id string, geometry string, start_location string, end_location string, start_at timestamp_ntz, end_at timestamp_ntz"
EVENT_SCHEMA = "vin string, data string, capability string"
VERTEX = "array<struct<lon:double,lat:double>>"


def typed_events(raw: DataFrame) -> DataFrame:
    """vin, capability, ts, lon, lat, status of location and engine events; all other kinds go."""
    place, engine = "$.vehicle_location.coordinates", "$.engine.status"
    only = lambda top, key: has_only_key(F.get_json_object("data", f"$.{top}"), key)
    kept = raw.where(((F.col("capability") == "vehicle_location") & only("vehicle_location", "coordinates")) | ((F.col("capability") == "engine") & only("engine", "status")))
    at = lambda path: F.get_json_object("data", path)
    return kept.select(
        "vin", "capability",
        wall_clock(F.coalesce(at(f"{place}.timestamp"), at(f"{engine}.timestamp"))).alias("ts"),
        at(f"{place}.data.longitude").try_cast("double").alias("lon"),
        at(f"{place}.data.latitude").try_cast("double").alias("lat"),
        at(f"{engine}.data").alias("status"),
    ).where("ts IS NOT NULL")


def driven_points(events: DataFrame, vehicles: DataFrame) -> DataFrame:
    """vehicle_id, ts, lon, lat while the last known engine status is on, or unknown; an engine event comes first at its time."""
    known = events.join(vehicles.select(F.col("id").alias("vehicle_id"), "vin"), "vin")
    state = forward_fill(known, ["vehicle_id"], ["ts", "capability", "lon", "lat"], "status", "engine")
    on = F.col("engine").isNull() | (F.col("engine") == "on")
    return state.where((F.col("capability") == "vehicle_location") & on & F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("vehicle_id", "ts", "lon", "lat")


def vertices(geometry: Column) -> Column:
    """array<struct<lon, lat>> of a point or line text."""
    pairs = F.split(F.regexp_extract(geometry, r"\(([^()]*)\)", 1), r"\s*,\s*")
    return F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit(" "), F.lit(1)).cast("double").alias("lon"), F.split_part(p, F.lit(" "), F.lit(2)).cast("double").alias("lat")))


def geometry_text(points: Column) -> Column:
    body = F.array_join(F.transform(points, lambda p: coordinates(p["lon"], p["lat"])), ",")
    return F.when(F.size(points) > 1, F.concat(F.lit("LINESTRING("), body, F.lit(")"))).otherwise(F.concat(F.lit("POINT("), body, F.lit(")")))


def without_repeats(points: Column) -> Column:
    """Vertices that differ from the one before."""
    return bound(points, lambda own: F.filter(own, lambda p, i: (i == 0) | (p != F.element_at(own, F.greatest(i, F.lit(1))))))


def last_trips(trips: DataFrame) -> DataFrame:
    """Each vehicle's trip of latest end."""
    return first_per_key(trips, ["vehicle_id"], [F.desc("end_at"), F.desc("start_at"), F.asc("geometry")])


def segments(points: DataFrame, last: DataFrame, gap: str = GAP, noise: float = NOISE_METRES) -> DataFrame:
    """vehicle_id, extends, points, start_at, end_at: pieces of the way between gaps.

    Points not after a vehicle's last trip are late and go. That trip's end goes along as a point of its own, so
    gaps and small moves are judged against it; a later piece begins with the raw point before it. A piece
    of only the carried point is no trip.
    """
    ends = last.select("vehicle_id", F.col("end_at").alias("ts"), F.element_at(vertices(F.col("geometry")), -1).alias("p")).select("vehicle_id", "ts", "p.lon", "p.lat")
    fresh = points.join(ends.select("vehicle_id", F.col("ts").alias("until")), "vehicle_id", "left").where("until IS NULL OR ts > until").drop("until")
    both = fresh.distinct().withColumn("carried", F.lit(False)).unionByName(ends.withColumn("carried", F.lit(True)))
    order = ["ts", "lon", "lat"]
    w = Window.partitionBy("vehicle_id").orderBy(*order)
    before = both.withColumn("before", F.lag(F.struct("lon", "lat")).over(w))
    split = sessions(moved(before, ["vehicle_id"], order, "lon", "lat", noise), ["vehicle_id"], "ts", gap, tie=["lon", "lat"])
    rows = F.array_sort(F.collect_list(F.struct("ts", "lon", "lat", "before", "carried")))
    grouped = split.groupBy("vehicle_id", "segment").agg(rows.alias("rows"))
    own = F.transform("rows", lambda r: F.struct(r["lon"].alias("lon"), r["lat"].alias("lat")))
    first = F.element_at("rows", 1)
    line = F.when((F.col("segment") > 0) & first["before"].isNotNull(), F.concat(F.array(first["before"]), own)).otherwise(own)
    out = grouped.select("vehicle_id", first["carried"].alias("extends"), line.cast(VERTEX).alias("points"), first["ts"].alias("start_at"), F.element_at("rows", -1)["ts"].alias("end_at"), F.size("rows").alias("n"))
    return out.where("NOT extends OR n > 1").drop("n")


def address_index(addresses: DataFrame) -> PlaceIndex:
    """Addresses, as number street postcode city, by their spot."""
    label = F.concat_ws(" ", "number", "street", "postal_code", "city")
    spot = F.element_at(vertices(F.col("geom")), 1)
    places = addresses.select(label.alias("place"), spot["lon"].alias("px"), spot["lat"].alias("py"))
    return place_index(places, "place", "px", "py")


def located(trips: DataFrame, addresses: DataFrame) -> DataFrame:
    """Trips with the nearest address of their first and last vertex."""
    ends = trips.select("vehicle_id", "start_at", F.posexplode(F.array(F.element_at(vertices(F.col("geometry")), 1), F.element_at(vertices(F.col("geometry")), -1))).alias("which", "p"))
    ends = ends.select(F.concat_ws("|", "vehicle_id", F.col("start_at").cast("string"), F.col("which").cast("string")).alias("id"), "p.lon", "p.lat")
    near = nearest_in(address_index(addresses), ends, "id", "lon", "lat")
    key = lambda k: F.concat_ws("|", "vehicle_id", F.col("start_at").cast("string"), F.lit(str(k)))
    pick = lambda k: near.select(F.col("id").alias(f"__id{k}"), F.col("place").alias(f"__place{k}"))
    met = trips.join(pick(0), key(0) == F.col("__id0"), "left").join(pick(1), key(1) == F.col("__id1"), "left")
    return met.withColumns({"start_location": F.col("__place0"), "end_location": F.col("__place1")}).select(*TRIP)


def next_trips(raw: DataFrame, vehicles: DataFrame, trips: DataFrame, addresses: DataFrame) -> DataFrame:
    """All trips after a batch of events: extended, new and untouched ones."""
    last = last_trips(trips)
    found = segments(driven_points(typed_events(raw), vehicles), last)
    extended = found.where("extends").select("vehicle_id", F.col("points").alias("more"), F.col("end_at").alias("until"))
    grown = last.join(extended, "vehicle_id").withColumn("geometry", geometry_text(without_repeats(F.concat(vertices(F.col("geometry")), "more")))).withColumn("end_at", F.col("until")).select(*TRIP)
    nothing = F.lit(None).cast("string")
    added = found.where("NOT extends").select("vehicle_id", geometry_text(without_repeats(F.col("points"))).alias("geometry"), nothing.alias("start_location"), nothing.alias("end_location"), "start_at", "end_at")
    changed = located(materialised(grown.unionByName(added)), addresses)
    same = trips.join(grown.select("vehicle_id", "start_at").distinct(), ["vehicle_id", "start_at"], "left_anti").select(*TRIP)
    return same.unionByName(changed)
