"""Streams of event files into the trip table, and event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymill.operators.common import materialised
from waymill.sources.files import routed_files
from waymill.sources.sinks import latest_version, replace, versions
from waymill.streaming.trips import EVENT_SCHEMA, TRIP_SCHEMA, next_trips


def event_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of JSON array files as they arrive; ``data`` may be an object or a text."""
    read = spark.readStream.schema(EVENT_SCHEMA).option("multiLine", True)
    return (read.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else read).json(folder)


#: Parts of the trip table, by the hash of the vehicle.
PARTS = 64


def part_of(vehicle: str = "vehicle_id") -> Column:
    return F.pmod(F.xxhash64(F.col(vehicle).cast("string")), F.lit(PARTS)).cast("int")


def _versions(spark: SparkSession, table: str, below: int | None = None) -> dict[int, int]:
    """The version that holds each part of a table; as many entries as parts at most."""
    found = latest_version(spark, f"{table}/parts", below)
    return {r.part: r.version for r in spark.read.parquet(found).collect()} if found else {}


def _read(spark: SparkSession, table: str, versions: dict[int, int]) -> DataFrame | None:
    paths = [f"{table}/v={version:010d}/part={part}" for part, version in sorted(versions.items())]
    return spark.read.schema(TRIP_SCHEMA).parquet(*paths) if paths else None


def trip_table(spark: SparkSession, table: str) -> DataFrame:
    """All trips as of the last whole micro-batch."""
    found = _read(spark, table, _versions(spark, table))
    return spark.createDataFrame([], TRIP_SCHEMA) if found is None else found


def _put(spark: SparkSession, trips: DataFrame, table: str, number: int, before: dict[int, int]) -> None:
    """Writes the parts that the trips have as a version, then which version holds each part; only the last makes them count."""
    path = f"{table}/v={number:010d}"
    trips.withColumn("part", part_of()).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)
    written = {r.part: number for r in trips.select(part_of().alias("part")).distinct().collect()}
    replace(spark.createDataFrame(sorted((before | written).items()), "part int, version long").coalesce(1), f"{table}/parts", number)


def run_trips(spark: SparkSession, folder: str, table: str, checkpoint: str, vehicles: DataFrame, addresses: DataFrame, start: DataFrame) -> StreamingQuery:
    """Processes all files there are; ``trip_table`` reads the result, which begins with the trips of ``start``.

    A micro-batch reads and writes only the parts of the vehicles that it has events of, as a version of its number,
    so a batch that runs again after a failure starts from the versions before it and writes the same.
    """
    if latest_version(spark, f"{table}/parts") is None:
        _put(spark, start, table, 0, {})

    def step(batch: DataFrame, number: int) -> None:
        batch = materialised(batch)
        before = _versions(spark, table, below=number + 1)
        touched = {r.part for r in batch.select("vin").join(vehicles.select("vin", F.col("id").alias("vehicle_id")), "vin").select(part_of().alias("part")).distinct().collect()}
        own = _read(spark, table, {p: v for p, v in before.items() if p in touched})
        stored = spark.createDataFrame([], TRIP_SCHEMA) if own is None else own
        _put(spark, materialised(next_trips(batch, vehicles, stored, addresses)), table, number + 1, before)

    return event_files(spark, folder).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def watermarked(events: DataFrame, at: str, delay: str | None) -> DataFrame:
    """Event time with a bound on late rows; Spark wants it as a timestamp, read in the session's time zone."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay) if delay else events


def tumbling(events: DataFrame, at: str, width: str, keys: list[str], value: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Counts and sums by window; with ``slide`` overlapping ones. On a stream, ``delay`` bounds state and late rows."""
    own = watermarked(events, at, delay)
    window = F.window(at, width, slide) if slide else F.window(at, width)
    grouped = own.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("total"))
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "n", "total")


def session_windows(events: DataFrame, at: str, gap: str, keys: list[str], delay: str | None = None) -> DataFrame:
    own = watermarked(events, at, delay)
    grouped = own.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), *keys, "n")


def distinct_events(events: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """Drops repeats that arrive within the delay."""
    return watermarked(events, at, delay).dropDuplicatesWithinWatermark(keys)


def kafka(spark: SparkSession, servers: str, topic: str, schema: str, **options: str) -> DataFrame:
    """JSON payloads of a topic; use with ``trigger(availableNow=True)`` to read what there is. Needs Spark's Kafka package."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")


def route_arrivals(spark: SparkSession, folder: str, routes: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Routes all files that have arrived, each once: those with exactly one route to ``table``/routed, others to ``table``/quarantine.

    routes: pattern, organisation, connector. A version of each table is a batch: path, modified, length and the route, or why
    there is none. Files are listed, not read. A batch that runs again writes the same versions; files of earlier ones are not seen again.
    """
    known = materialised(routes)
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("recursiveFileLookup", True).load(folder)

    def step(batch: DataFrame, number: int) -> None:
        met = materialised(routed_files(batch, known))
        replace(met.where("n_routes = 1").drop("n_routes"), f"{table}/routed", number)
        fault = F.when(F.col("n_routes") == 0, F.lit("no route")).otherwise(F.concat(F.col("n_routes").cast("string"), F.lit(" routes")))
        others = met.where("n_routes <> 1").groupBy("path", "modified", "length").agg(F.min(fault).alias("fault"), F.array_sort(F.collect_set("pattern")).alias("patterns"))
        replace(others, f"{table}/quarantine", number)

    listed = files.select("path", F.col("modificationTime").alias("modified"), "length")
    return listed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(spark: SparkSession, table: str, which: str) -> DataFrame:
    """All files so far of "routed" or "quarantine"."""
    paths = [p for _, p in versions(spark, f"{table}/{which}")]
    more = "pattern string, organisation string, connector string" if which == "routed" else "fault string, patterns array<string>"
    schema = f"path string, modified timestamp, length bigint, {more}"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
