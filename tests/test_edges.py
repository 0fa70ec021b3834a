"""Empty tables, nulls, ties and repeats; and rules that must hold whatever the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from waymill.operators import dedupe, expect, finance, joins, lookup, merge, reshape, spatial, synth, timeseries
from waymill.sources import files

D = dt.datetime
IV = "k string, s timestamp_ntz, e timestamp_ntz, v int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def intervals(spark):
    rng = random.Random(4)
    made = [(rng.choice("ab"), D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 300)), rng.choice([None, 20, 40]), k) for k in range(60)]
    return spark.createDataFrame([(k, s, s + dt.timedelta(days=n) if n else None, v) for k, s, n, v in made] + [(None, D(2024, 1, 1), None, 1), ("c", None, None, 2)], IV)


def test_merged_intervals_do_not_touch_and_do_not_depend_on_order(spark, intervals):
    once = timeseries.merged_intervals(intervals, ["k"], "s", "e")
    shuffled = spark.createDataFrame(random.Random(1).sample(intervals.collect(), intervals.count()), IV)
    assert rows(once) == rows(timeseries.merged_intervals(shuffled, ["k"], "s", "e"))
    assert expect.interval_faults(once, ["k"], "s", "e", []).count() == 0
    again = timeseries.merged_intervals(once, ["k"], "s", "e").drop("n_merged")
    assert rows(again) == rows(once.drop("n_merged"))


def test_dedupe_is_idempotent(spark, intervals):
    once = dedupe.conflict_to_null(intervals, ["k"], ["v"], ["s"])
    assert rows(dedupe.conflict_to_null(once, ["k"], ["v"], ["s"])) == rows(once)
    assert once.where("k IS NULL").count() == 1
    latest = dedupe.latest_per_column(intervals, ["k"], "s", {"v": "null", "e": "max"})
    assert rows(latest.where("k = 'c'")) == [("c", 2, None)]
    assert dedupe.keep_extreme(intervals.where("k = 'c'"), ["k"], "s").count() == 1


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a", None), (2, None, 5)], "k int, x string, y int")
    new = spark.createDataFrame([(1, None, 7), (3, "n", None), (None, "lost", 1)], target.schema)
    for mode in merge.MODES:
        once = merge.upsert(target, new, ["k"], mode)
        assert rows(merge.upsert(once, new, ["k"], mode)) == rows(once) and once.count() == 3
    assert rows(merge.upsert(target, new, ["k"], "overwrite", columns=["y"])) == [(1, "a", 7), (2, None, 5), (3, "n", None)]
    with pytest.raises(ValueError):
        merge.upsert(target, new, ["k"], "other")


def test_best_interval_keeps_each_row_once(spark, intervals):
    facts = spark.createDataFrame([("a", D(2024, 6, 1)), ("a", D(2024, 6, 1)), ("z", D(2024, 6, 1)), (None, D(2024, 6, 1)), ("b", None)], "k string, at timestamp_ntz")
    for how in ({}, {"fallback": [("__start", True), ("v", False)]}, {"fallback": [("__start", True)], "mask_fallback": True}):
        out = joins.best_interval(facts, intervals, "k", "at", "s", "e", [("__start", True), ("v", False)], ["v"], **how)
        assert out.count() == facts.count() and out.columns == ["k", "at", "v", "matched"]
    assert joins.best_interval(facts.limit(0), intervals, "k", "at", "s", "e", [("v", False)], ["v"]).count() == 0
    assert joins.best_interval(facts, intervals.limit(0), "k", "at", "s", "e", [("v", False)], ["v"]).where("matched").count() == 0


def test_parameters_valid_now(spark):
    params = spark.createDataFrame([("old", None, D(2020, 1, 1)), ("now", D(2020, 1, 2), None), ("all", None, None), ("next", D(2030, 1, 1), None)], "name string, date_from timestamp_ntz, date_to timestamp_ntz")
    found = joins.valid_at(params, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert {r.name for r in found.collect()} == {"now", "all"}


def test_nearest_of_far_points_and_ties(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, 0.0), (3, 0.5, 0.0)], "id int, x double, y double")
    places = spark.createDataFrame([("b", 1.0, 0.0), ("a", -1.0, 0.0), ("a2", 1.0, 0.0)], "place string, px double, py double")
    out = spatial.nearest(points, places, "id", "x", "y", "place", "px", "py")
    assert rows(out) == [(1, "a", 1.0), (2, "a2", 499.0), (3, "a2", 0.5)]
    assert spatial.nearest(points.limit(0), places, "id", "x", "y", "place", "px", "py").count() == 0


def test_vat_is_inferred_again_after_a_change(spark):
    df = spark.createDataFrame([(1, "fuel", 100.0, 120.0, 20.0), (2, "rent", 50.0, 60.0, 10.0)], "k int, category string, amount_tax_exc double, amount_tax_inc double, vat_value double")
    doubled = synth.changed(df, "amount_tax_exc", F.col("category") == "fuel", "k", factor=(2.0, 2.0)).withColumns({"amount_tax_inc": F.lit(None).cast("double"), "vat_value": F.lit(None).cast("double")})
    again = finance.infer_amounts(doubled, "category")
    vat = finance.deductible_vat(F.lit("personal"), F.col("category"), F.lit("diesel"), F.col("vat_value"))
    assert rows(again.select("k", "amount_tax_inc", "vat_value", vat.alias("d"))) == [(1, 240.0, 40.0, 32.0), (2, 60.0, 10.0, 0.0)]
    moved = synth.changed(df, "category", F.lit(True), "k", choices=["x", "y"], seed=1)
    assert rows(moved) == rows(synth.changed(df, "category", F.lit(True), "k", choices=["x", "y"], seed=1))


def test_pseudonymous_people(spark):
    df = spark.createDataFrame([("k1", "Anna"), ("k2", None)], "k string, name string").withColumn("first", synth.word_pseudonym(F.col("name"), ["Ada", "Bo"]))
    out = df.select("*", *[c.alias(n) for n, c in synth.person_fields(F.col("first"), F.lit("Roe"), F.col("k")).items()]).collect()
    assert out[0].first in ("Ada", "Bo") and out[0].email == f"{out[0].first.lower()}.roe@example.com" and out[1].email is None
    assert len({r.phone for r in out}) == 2 and all(len(r.phone) == 10 for r in out)


def test_rows_and_paths(spark):
    df = spark.createDataFrame([(1, None, "A", ""), (None, None, None, None)], "a int, b int, p string, q string")
    out = df.select(reshape.row_total(["a", "b"]).alias("t"), reshape.path_of([F.col("p"), F.col("q")]).alias("path"))
    assert rows(out) == [(0, None), (1, "A")]
    assert df.select(reshape.last_level(F.lit("A > B > C")).alias("v")).first().v == "C"


def test_previous_month_and_window(spark):
    first, last = timeseries.previous_month(F.lit("2024-03-15").cast("date"))
    assert tuple(spark.range(1).select(first, last).first()) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 4),), (D(2024, 1, 9),)], "at timestamp_ntz")
    assert files.widened(df, "2024-01-04", "2024-01-07", 1, "at").count() == 1


def test_readings_follow_the_last_accepted_one(spark):
    df = spark.createDataFrame([("v", D(2024, 1, d), float(km)) for d, km in ((1, 100), (2, 200), (3, 50), (4, 250), (4, 250), (5, 90000))] + [("v", None, 1.0), (None, D(2024, 1, 1), 1.0), ("v", D(2024, 1, 6), None)], "k string, at timestamp_ntz, km double")
    assert [r.km for r in timeseries.plausible_readings(df, "k", "at", "km").orderBy("at", "km").collect()] == [100.0, 200.0, 250.0, 250.0]


def test_empty_tables(spark, intervals):
    none = intervals.limit(0)
    assert timeseries.merged_intervals(none, ["k"], "s", "e").count() == 0
    assert timeseries.month_spine(none, ["k"], "s", "e").count() == 0
    assert timeseries.sessions(none, ["k"], "s", "1 HOUR").count() == 0
    assert dedupe.first_values(none, ["k"], ["s"], ["v"]).count() == 0
    assert lookup.mapped(none, "k", none, "k", "k").count() == 0
    assert lookup.surrogate_keys(none, ["k", "v"], "id")[1].count() == 0
    assert joins.paths(none.selectExpr("k AS id", "k AS name", "k AS parent"), "id", "name", "parent").count() == 0
    assert merge.new_versions(none, none, ["k"], "s", "e", {"v": "number"}).count() == 0
    assert merge.reconciliation(none, none, "k", {"v": "differs"}).count() == 0
    assert expect.availability(none, ["k"]).first().missing_share is None
    assert {r.n for r in expect.violations(none, [expect.Expected("k", "string", nullable=False, unique=True)]).collect()} == {0}
