"""Queries over ordered rows: trips, fills, spines, intervals, readings, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.functions.standardise import haversine
from waymill.operators import timeseries as ts
from waymill.operators.dedupe import current_version, first_per_key
from waymill.plans.tables import ORDER_INTERVALS, cents, dsum, order_intervals, table
from waymill.streaming import keyed, stream, trips


def trip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    cut = ts.sessions(events, ["user_id"], "ts", "8 HOURS", tie=["event_id"])
    at = F.struct("ts", "event_id")
    return cut.groupBy("user_id", "segment").agg(
        F.min("ts").alias("start_at"), F.max("ts").alias("end_at"), F.count("*").alias("n"),
        F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda r: r["event_id"].cast("string")), ",").alias("path"),
    )


TRIP_SEGMENTS = """WITH f AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 8 HOURS THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM f)
 SELECT user_id, segment, min(ts) AS start_at, max(ts) AS end_at, count(*) AS n, first(value ORDER BY ts, event_id) AS first_value, last(value ORDER BY ts, event_id) AS last_value,
 string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS path FROM s GROUP BY user_id, segment"""


def engine_gating(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "signup", "on").when(F.col("event_type") == "error", "off")
    events = table(spark, sf_dir, "events").withColumn("status", status)
    known = ts.forward_fill(events, ["user_id"], ["ts", "event_type", "event_id"], "status", "engine")
    return known.where("status IS NULL AND coalesce(engine, 'on') = 'on'").select("event_id", "user_id", "ts", "engine")


ENGINE_GATING = """WITH s AS (SELECT *, CASE event_type WHEN 'signup' THEN 'on' WHEN 'error' THEN 'off' END AS status FROM events),
 f AS (SELECT *, last_value(status IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_type, event_id ROWS UNBOUNDED PRECEDING) AS engine FROM s)
 SELECT event_id, user_id, ts, engine FROM f WHERE status IS NULL AND coalesce(engine, 'on') = 'on'"""


def late_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    mark = F.lit("2024-01-16").cast("timestamp_ntz")
    seen = events.where(F.col("ts") < mark).where("event_type <> 'view'").groupBy("user_id").agg(F.max("ts").alias("until"))
    met = events.join(seen, "user_id", "left")
    return met.where("until IS NULL OR ts > until").groupBy("user_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_kept"))


LATE_FILTER = """WITH seen AS (SELECT user_id, max(ts) AS until FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'view' GROUP BY user_id)
 SELECT user_id, count(*) AS n, min(ts) AS first_kept FROM events LEFT JOIN seen USING (user_id) WHERE until IS NULL OR ts > until GROUP BY user_id"""


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = F.pmod(F.col("value") * 7, F.lit(3.0)), F.lit(45.0) + F.pmod(F.col("value") * 3, F.lit(2.0))
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", lon.alias("lon"), lat.alias("lat"))


def point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = haversine(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat"))
    out = _placed(spark, sf_dir).withColumn("km", F.round(gap / 1000, 3))
    return out.where("km IS NULL OR km > 15").select("event_id", "km")


POINT_DISTANCE = """WITH p AS (SELECT user_id, event_id, ts, (value * 7) % 3.0::DOUBLE AS lon, 45 + (value * 3) % 2.0::DOUBLE AS lat FROM events),
 l AS (SELECT *, lag(lon) OVER w AS lon0, lag(lat) OVER w AS lat0 FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 d AS (SELECT event_id, round(2 * 6371.0088 * asin(sqrt(least(1, sin(radians(lat - lat0) / 2) ^ 2 + cos(radians(lat0)) * cos(radians(lat)) * sin(radians(lon - lon0) / 2) ^ 2))), 3) AS km, lon0 FROM l)
 SELECT event_id, CASE WHEN lon0 IS NOT NULL THEN km END AS km FROM d WHERE lon0 IS NULL OR km > 15"""


def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    held = orders.select("o_custkey", F.col("o_orderdate").alias("date_from"), (F.col("o_orderdate") + F.expr("make_dt_interval(cast(o_orderkey % 120 as int))")).alias("date_to"), "o_orderkey")
    merged = ts.merged_intervals(held, ["o_custkey"], "date_from", "date_to", ["o_orderkey"])
    return merged.select("o_custkey", "date_from", "date_to", "n_merged", F.col("o_orderkey").alias("first_order"))


INTERVAL_MERGE = """WITH h AS (SELECT o_custkey, o_orderkey, o_orderdate AS s, o_orderdate + to_days(CAST(o_orderkey % 120 AS INT)) AS e FROM orders),
 r AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h),
 i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY s, e, o_orderkey ROWS UNBOUNDED PRECEDING) AS island FROM r)
 SELECT o_custkey, min(s) AS date_from, max(e) AS date_to, count(*) AS n_merged, first(o_orderkey ORDER BY s, e, o_orderkey) AS first_order FROM i GROUP BY o_custkey, island"""


def month_spine_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ts.monthly_gaps(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice").select("o_custkey", F.col("month").cast("string").alias("month"), F.round("amount", 4).alias("amount"))


MONTH_SPINE_FILL = """WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2),
 l AS (SELECT o_custkey, median(total) AS amount, min(month) AS a, max(month) AS b FROM m GROUP BY 1),
 s AS (SELECT o_custkey, amount, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM l)
 SELECT o_custkey, CAST(month AS VARCHAR) AS month, round(amount, 4) AS amount FROM s ANTI JOIN m USING (o_custkey, month)"""


def recurring_extrapolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    contracts = order_intervals(spark, sf_dir).select(
        "o_orderkey", F.to_date("date_from").alias("date_from"), F.to_date("date_to").alias("date_to"),
        F.col("o_totalprice").alias("rent"), F.when(F.col("o_orderkey") % 3 == 0, 50.0).alias("services"))
    return ts.recurring(contracts, ["o_orderkey"], "date_from", "date_to", F.lit("2002-01-01").cast("date"), ["rent", "services"]).withColumn("due", F.col("due").cast("string"))


RECURRING_EXTRAPOLATION = f"""WITH {ORDER_INTERVALS},
 c AS (SELECT o_orderkey, CAST(date_from AS DATE) AS f, least(coalesce(CAST(date_to AS DATE), DATE '2002-01-01'), DATE '2002-01-01') AS t, o_totalprice AS rent, CASE WHEN o_orderkey % 3 = 0 THEN 50.0::DOUBLE END AS services FROM iv),
 k AS (SELECT *, unnest(range(0, 100)) AS k FROM c), d AS (SELECT *, CAST(f + to_months(CAST(k AS INT)) AS DATE) AS due FROM k),
 w AS (SELECT * FROM d WHERE due <= t AND due < DATE '2002-01-01')
 SELECT o_orderkey, CAST(due AS VARCHAR) AS due, 'rent' AS category, rent AS amount FROM w WHERE rent IS NOT NULL UNION ALL SELECT o_orderkey, CAST(due AS VARCHAR), 'services', services FROM w WHERE services IS NOT NULL"""


def odometer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    raw = table(spark, sf_dir, "events").withColumn("n", F.row_number().over(w)).select("user_id", "ts", (F.col("n") * 100 + F.when(F.col("event_id") % 11 == 0, -900).when(F.col("event_id") % 13 == 0, 4000).otherwise(0)).cast("double").alias("km"))
    return ts.plausible_readings(raw, "user_id", "ts", "km")


ODOMETER_FILTER = """WITH RECURSIVE r AS (SELECT user_id, ts, CAST(n * 100 + CASE WHEN event_id % 11 = 0 THEN -900 WHEN event_id % 13 = 0 THEN 4000 ELSE 0 END AS DOUBLE) AS km,
   row_number() OVER (PARTITION BY user_id ORDER BY ts, CAST(n * 100 + CASE WHEN event_id % 11 = 0 THEN -900 WHEN event_id % 13 = 0 THEN 4000 ELSE 0 END AS DOUBLE)) AS i
   FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)),
 f AS (SELECT user_id, i, ts, km, true AS ok, ts AS lts, km AS lkm FROM r WHERE i = 1
  UNION ALL SELECT user_id, i, ts, km, ok, CASE WHEN ok THEN ts ELSE lts END, CASE WHEN ok THEN km ELSE lkm END FROM (
   SELECT r.user_id, r.i, r.ts, r.km, f.lts, f.lkm, r.km >= f.lkm AND r.km - f.lkm <= 1000 * greatest(date_diff('day', f.lts, r.ts), 1) AND r.km - f.lkm <= 5000 * (floor(date_diff('day', f.lts, r.ts) / 7) + 1) AS ok
   FROM f JOIN r ON r.user_id = f.user_id AND r.i = f.i + 1))
 SELECT user_id, ts, km FROM f WHERE ok"""


def reading_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = ts.differences(lines, ["o_custkey"], "o_orderdate", "o_totalprice", ["o_orderkey"])
    return out.select("o_orderkey", F.round("reading_diff", 2).alias("reading_diff"), F.col("days_diff").cast("double").alias("days_diff"))


READING_DIFFERENCES = """SELECT o_orderkey, round(o_totalprice - lag(o_totalprice) OVER w, 2) AS reading_diff, CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE) AS days_diff
 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""


def active_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date")
    days = ts.active_days(F.col("date_from"), F.col("date_to"), low, high)
    return order_intervals(spark, sf_dir).groupBy("o_custkey").agg(F.sum(days).alias("days_active"), F.round(F.sum(days) / 365, 6).alias("full_time_equivalent"))


ACTIVE_DAYS = f"""WITH {ORDER_INTERVALS}, d AS (SELECT o_custkey, greatest(date_diff('day', greatest(CAST(date_from AS DATE), DATE '1998-01-01'), least(coalesce(CAST(date_to AS DATE), DATE '1998-12-31'), DATE '1998-12-31')) + 1, 0) AS d FROM iv)
 SELECT o_custkey, CAST(sum(d) AS BIGINT) AS days_active, round(sum(d) / 365, 6) AS full_time_equivalent FROM d GROUP BY 1"""


def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = current_version(order_intervals(spark, sf_dir), ["o_custkey"], "date_from", "date_to", F.lit("2002-01-01").cast("timestamp_ntz"), ["o_orderkey"])
    tied = current_version(ranked, ["o_custkey"], "date_from", "date_to", F.lit("2002-01-01").cast("timestamp_ntz"), [], "tie_rank", True)
    return tied.where("version_rank <= 2").select("o_custkey", "o_orderkey", F.col("version_rank").cast("bigint").alias("version_rank"), F.col("tie_rank").cast("bigint").alias("tie_rank"))


CURRENT_VERSIONS = f"""WITH {ORDER_INTERVALS}, r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY date_from DESC, coalesce(date_to, TIMESTAMP '2002-01-01') DESC, o_orderkey) AS version_rank,
 rank() OVER (PARTITION BY o_custkey ORDER BY date_from DESC, coalesce(date_to, TIMESTAMP '2002-01-01') DESC) AS tie_rank FROM iv) SELECT * FROM r WHERE version_rank <= 2"""


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "ts", "event_type")


LATEST_EVENT = "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id"


def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.tumbling(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], "value")


def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.tumbling(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], "value", slide="15 minutes")


def _windows(steps: str) -> str:
    return f"""WITH w AS (SELECT *, time_bucket(INTERVAL {'15 minutes' if steps != '0' else '1 hour'}, ts) - {steps} AS window_start FROM events)
 SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM w GROUP BY ALL"""


TUMBLING = _windows("0").replace(" - 0 AS", " AS")
SLIDING = _windows("CAST(unnest(range(0, 4)) AS INT) * INTERVAL 15 MINUTES")


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.session_windows(table(spark, sf_dir, "events"), "ts", "8 hours", ["user_id"])


SESSION = """WITH f AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 8 HOURS THEN 1 ELSE 0 END AS new FROM events),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f)
 SELECT min(ts) AS session_start, max(ts) + INTERVAL 8 HOURS AS session_end, user_id, count(*) AS n FROM s GROUP BY user_id, k"""


def monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.trunc("l_shipdate", "month").cast("string").alias("month"), "l_returnflag", "l_suppkey").agg(dsum("l_extendedprice").alias("amount"), dsum(F.col("l_extendedprice") * F.col("l_tax")).alias("vat"), dsum("l_quantity").alias("quantity"), F.count("*").alias("n"))


MONTHLY_ROLLUP = """SELECT CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS month, l_returnflag, l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS amount,
 CAST(sum(CAST(l_extendedprice * l_tax AS DECIMAL(18,4))) AS DOUBLE) AS vat, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity, count(*) AS n FROM lineitem GROUP BY ALL"""


def mileage_per_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings inside each attribution: first, last and what was driven, by month."""
    iv = order_intervals(spark, sf_dir).select("o_custkey", F.col("o_orderkey").alias("attribution"), "date_from", "date_to")
    readings = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").alias("at"), cents("o_totalprice").alias("km"))
    met = readings.join(iv, "o_custkey").where("at >= date_from AND (date_to IS NULL OR at < date_to)")
    return met.groupBy("attribution", F.trunc("at", "month").cast("string").alias("month")).agg(F.count("*").alias("n"), F.min("km").cast("double").alias("first_km"), F.max("km").cast("double").alias("last_km"), (F.max("km") - F.min("km")).cast("double").alias("driven"))


MILEAGE_PER_PERIOD = f"""WITH {ORDER_INTERVALS} SELECT iv.o_orderkey AS attribution, CAST(CAST(date_trunc('month', o.o_orderdate) AS DATE) AS VARCHAR) AS month, count(*) AS n, min(o.o_totalprice) AS first_km, max(o.o_totalprice) AS last_km,
 CAST(CAST(max(o.o_totalprice) AS DECIMAL(18,4)) - CAST(min(o.o_totalprice) AS DECIMAL(18,4)) AS DOUBLE) AS driven
 FROM orders o JOIN iv ON o.o_custkey = iv.o_custkey AND o.o_orderdate >= date_from AND (date_to IS NULL OR o.o_orderdate < date_to) GROUP BY 1, 2"""


def raw_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Device messages made of the events, the vehicles of their devices, and addresses made of the suppliers.

    Two vehicles' worth of users; places move by some 100 m or by 5 m; errors and signups turn an engine off and on; other
    messages, unknown devices and messages of another shape are among them.
    """
    e = table(spark, sf_dir, "events")
    vin = F.when(F.col("user_id") % 11 == 0, F.lit("nobody")).otherwise(F.concat(F.lit("vin-"), F.col("user_id") % 2))
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    lon, lat = (F.floor(F.col("event_id") / 3) % 50 * 0.001).cast("double"), (F.col("user_id") % 20 * 0.00005).cast("double")
    place = F.to_json(F.struct(F.struct(F.struct(F.struct(lon.alias("longitude"), lat.alias("latitude")).alias("data"), at.alias("timestamp")).alias("coordinates")).alias("vehicle_location")))
    status = F.when(F.col("event_type") == "error", "off").otherwise("on")
    engine = F.to_json(F.struct(F.struct(F.struct(status.alias("data"), at.alias("timestamp")).alias("status")).alias("engine")))
    is_engine, is_other = F.col("event_type").isin("error", "signup"), F.col("event_id") % 13 == 0
    kind = F.when(is_other, "diagnostics").when(is_engine, "engine").otherwise("vehicle_location")
    raw = e.select(vin.alias("vin"), F.when(is_engine, engine).otherwise(place).alias("data"), kind.alias("capability"))
    vehicles = e.select((F.col("user_id") % 2).alias("k")).distinct().select(F.concat(F.lit("v"), "k").alias("id"), F.concat(F.lit("vin-"), "k").alias("vin"))
    spot = F.concat(F.lit("POINT("), (F.col("s_suppkey") % 50 * 0.001).cast("decimal(9,3)").cast("string"), F.lit(" 0.0003)"))
    addresses = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("number"), F.lit("street").alias("street"), F.lit("1").alias("postal_code"), F.col("s_name").alias("city"), spot.alias("geom"))
    return raw, vehicles, addresses


def shown_trips(out: DataFrame) -> DataFrame:
    v = trips.vertices(F.col("geometry"))
    ends = {f"{name}_{c}": F.round(F.element_at(v, k)[c], 6) for k, name in ((1, "first"), (-1, "last")) for c in ("lon", "lat")}
    return out.select("vehicle_id", "start_at", "end_at", F.size(v).cast("bigint").alias("n_vertices"), F.startswith("geometry", F.lit("LINE")).alias("is_line"), *[c.alias(n) for n, c in ends.items()], "start_location", "end_location")


def trip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of all messages: typed, joined to vehicles, gated by engine, freed of small moves, cut at gaps, connected, located."""
    raw, vehicles, addresses = raw_messages(spark, sf_dir)
    return shown_trips(trips.next_trips(raw, vehicles, spark.createDataFrame([], trips.TRIP_SCHEMA), addresses))


def keyed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the state processor of the stream, run over all messages as one batch."""
    raw, vehicles, addresses = raw_messages(spark, sf_dir)
    none = spark.createDataFrame([], trips.TRIP_SCHEMA)
    pieces = keyed.placed(keyed.keyed_pieces(raw, vehicles, none), trips.address_index(addresses))
    return shown_trips(keyed.folded(none, pieces))


TRIP_TABLE = r"""WITH m AS (SELECT CASE user_id % 2 WHEN 0 THEN 'v0' ELSE 'v1' END AS vehicle_id, ts, CASE WHEN event_type IN ('error', 'signup') THEN 'engine' ELSE 'vehicle_location' END AS kind, CASE event_type WHEN 'error' THEN 'off' WHEN 'signup' THEN 'on' END AS status,
   CAST(floor(event_id / 3) % 50 AS DOUBLE) * CAST(0.001 AS DOUBLE) AS lon, CAST(user_id % 20 AS DOUBLE) * CAST(0.00005 AS DOUBLE) AS lat FROM events WHERE user_id % 11 <> 0 AND event_id % 13 <> 0),
 g AS (SELECT *, last_value(status IGNORE NULLS) OVER (PARTITION BY vehicle_id ORDER BY ts, kind, lon, lat ROWS UNBOUNDED PRECEDING) AS engine FROM m),
 p AS (SELECT DISTINCT vehicle_id, ts, lon, lat FROM g WHERE kind = 'vehicle_location' AND coalesce(engine, 'on') = 'on'),
 b AS (SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM p WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, lon, lat)),
 d AS (SELECT * FROM b WHERE plon IS NULL OR 2 * 6371008.8 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))) > 15),
 n AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 10 MINUTES THEN 1 ELSE 0 END AS new FROM d WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, lon, lat)),
 s AS (SELECT *, sum(new) OVER (PARTITION BY vehicle_id ORDER BY ts, lon, lat ROWS UNBOUNDED PRECEDING) AS seg FROM n),
 x AS (SELECT vehicle_id, seg, ts, lon, lat, 1 AS mine FROM s UNION ALL SELECT vehicle_id, seg, ts, plon, plat, 0 FROM s WHERE new = 1),
 o AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id, seg ORDER BY ts, mine, lon, lat) AS k FROM x),
 l AS (SELECT *, CASE WHEN lag(lon) OVER w = lon AND lag(lat) OVER w = lat THEN 0 ELSE 1 END AS own FROM o WINDOW w AS (PARTITION BY vehicle_id, seg ORDER BY k)),
 t AS (SELECT vehicle_id, min(ts) AS start_at, max(ts) AS end_at, CAST(sum(own) AS BIGINT) AS n_vertices, arg_min(lon, k) AS flon, arg_min(lat, k) AS flat, arg_max(lon, k) AS llon, arg_max(lat, k) AS llat FROM l GROUP BY vehicle_id, seg),
 a AS (SELECT s_suppkey || ' street 1 ' || s_name AS label, CAST(CAST(s_suppkey % 50 * 0.001 AS DECIMAL(9,3)) AS DOUBLE) AS px, CAST(0.0003 AS DOUBLE) AS py FROM supplier),
 c AS (SELECT lon, lat, arg_min(label, (sqrt(pow(px - lon, 2) + pow(py - lat, 2)), label)) AS label FROM (SELECT flon AS lon, flat AS lat FROM t UNION SELECT llon, llat FROM t), a GROUP BY 1, 2)
 SELECT vehicle_id, start_at, end_at, n_vertices, n_vertices > 1 AS is_line, round(flon, 6) AS first_lon, round(flat, 6) AS first_lat, round(llon, 6) AS last_lon, round(llat, 6) AS last_lat, f.label AS start_location, e.label AS end_location
 FROM t JOIN c AS f ON f.lon = flon AND f.lat = flat JOIN c AS e ON e.lon = llon AND e.lat = llat"""


QUERIES = {
    "q_trip_segments": (trip_segments, TRIP_SEGMENTS),
    "q_trip_table": (trip_table, TRIP_TABLE),
    "q_keyed_trips": (keyed_trips, TRIP_TABLE),
    "q_engine_gating": (engine_gating, ENGINE_GATING),
    "q_late_filter": (late_filter, LATE_FILTER),
    "q_point_distance": (point_distance, POINT_DISTANCE),
    "q_interval_merge": (interval_merge, INTERVAL_MERGE),
    "q_month_spine_fill": (month_spine_fill, MONTH_SPINE_FILL),
    "q_recurring_extrapolation": (recurring_extrapolation, RECURRING_EXTRAPOLATION),
    "q_odometer_filter": (odometer_filter, ODOMETER_FILTER),
    "q_reading_differences": (reading_differences, READING_DIFFERENCES),
    "q_mileage_per_period": (mileage_per_period, MILEAGE_PER_PERIOD),
    "q_active_days": (active_days, ACTIVE_DAYS),
    "q_current_version": (current_versions, CURRENT_VERSIONS),
    "q_latest_event": (latest_event, LATEST_EVENT),
    "q_tumbling": (tumbling, TUMBLING),
    "q_sliding": (sliding, SLIDING),
    "q_session": (session, SESSION),
    "q_monthly_rollup": (monthly_rollup, MONTHLY_ROLLUP),
}
