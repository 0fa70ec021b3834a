"""Country lookups, mapping tables, and event-time windows as batch and as stream."""

import pytest
from pyspark.sql import functions as F

from waymill.operators import lookup
from waymill.streaming import stream

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.fixture(scope="module")
def countries(spark):
    names = [("France", "FRA"), ("FR", "FRA"), ("FRA", "FRA"), ("Suisse", "CHE"), ("Switzerland", "CHE"), ("États-Unis", "USA"), ("United States", "USA")]
    return spark.createDataFrame(names, "name_key string, alpha3 string")


CASES = {"France": "FRA", "france": "FRA", "FRANCE": "FRA", " france": "FRA", "FR": "FRA", "fr": "FRA", "FRA": "FRA", "fra": "FRA", "Suisse": "CHE", "Switzerland": "CHE", "États-Unis": "USA", "etats-unis": "USA", None: ""}


def test_country_codes(spark, countries):
    df = spark.createDataFrame([(k, name) for k, name in enumerate(CASES)], "k int, country string")
    found = {r.k: r.country for r in lookup.country_codes(df, "country", countries).collect()}
    assert [found[k] for k in range(len(CASES))] == list(CASES.values())


def test_unknown_country_fails_or_stays_null(spark, countries):
    df = spark.createDataFrame([("Atlantis",)], "country string")
    with pytest.raises(Exception, match="no country Atlantis"):
        lookup.country_codes(df, "country", countries).collect()
    assert lookup.country_codes(df, "country", countries, strict=False).first().country is None
    assert lookup.country_codes(df.limit(0), "country", countries).count() == 0


def test_country_in_text(spark, countries):
    df = spark.createDataFrame([(1, "Hotel in the united states, near FR"), (2, "francesca"), (3, None)], "k int, text string")
    found = {r.k: r.code for r in lookup.found_in_text(df, "text", "k", countries, "name_key", "alpha3", "code").collect()}
    assert found == {1: "USA", 2: None, 3: None}


def test_equal_headers(spark):
    df = spark.createDataFrame([(1, 1), (None, None)], "a int, b int")
    assert lookup.same_content(df, "a", "b").first().same
    assert not lookup.same_content(df.withColumn("b", F.lit(2)), "a", "b").first().same


def streamed(spark, df, folder, query):
    """Rows of a query over a stream of files, the last of them far in the future so that all windows close."""
    df.write.parquet(folder)
    late = df.limit(1).withColumn("ts", F.lit("2030-01-01").cast("timestamp_ntz")).withColumn("event_type", F.lit("end"))
    late.write.mode("append").parquet(folder)
    source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1000).parquet(folder)
    name = f"out_{abs(hash(folder)) % 10**8}"
    run = query(source).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", folder + "-checkpoint").start()
    run.processAllAvailable()
    run.stop()
    return spark.table(name)


@pytest.mark.parametrize("slide", [None, "15 minutes"])
def test_windows_of_a_stream_equal_those_of_a_batch(spark, sf_dir, tmp_path, slide):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    want = stream.tumbling(events, "ts", "1 hour", ["event_type"], "value", slide).collect()
    out = streamed(spark, events, str(tmp_path / "in"), lambda s: stream.tumbling(s, "ts", "1 hour", ["event_type"], "value", slide, delay="1 hour"))
    assert sorted(out.where("event_type <> 'end'").collect()) == sorted(want)


def test_repeats_within_the_delay_are_dropped(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = streamed(spark, events.unionByName(events), str(tmp_path / "in"), lambda s: stream.distinct_events(s, ["event_id", "event_type"], "ts", "1 hour"))
    assert out.where("event_type <> 'end'").count() == events.count()


def test_few_keys_are_sent_whole_to_texts_that_share_a_first_word(spark):
    """Every text has the word, so a join by it would bring all texts into one task."""
    texts = spark.range(50).selectExpr("id", "concat('brand ', id % 7) AS text")
    keys = spark.range(7).selectExpr("concat('brand ', id) AS key", "id AS value")
    out = lookup.found_in_text(texts, "text", "id", keys, "key", "value", "found")
    assert "strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.found == r.id % 7 for r in out.collect())
