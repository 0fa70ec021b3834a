"""Interval joins by the index: blocks cover exactly, results as those of the direct join, time near linear."""

import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waymill.operators import intervals, joins

ORDERS = [[("__start", True)], [("v", False)], [("w", True), ("__end", True)], [("flag", True), ("day", False)]]
FACTS, VERSIONS = "id int, k string, at timestamp, __start string", "k string, s timestamp, e timestamp, v string, w double, flag boolean, day date"


def test_blocks_are_disjoint_and_cover_exactly(spark):
    rng = random.Random(1)
    rows = [(a := rng.randrange(3000), a + rng.choice([0, 1, 2, 5, 70, 900, -3])) for _ in range(400)] + [(0, 4096), (0, 0), (1, 4095), (64, 128)]
    df = spark.createDataFrame(rows, "low long, high long").select("low", "high", intervals.blocks("low", "high", 7).alias("b"))
    for r in df.collect():
        held = [x for b in r.b for x in range(b.block * 4**b.level, (b.block + 1) * 4**b.level)]
        assert sorted(held) == list(range(r.low, r.high)) and len(r.b) <= 6 * 7


def world(seed: int, whole_days: bool) -> tuple[list, list]:
    rng = random.Random(seed)
    t0 = datetime(2020, 1, 1)
    when = lambda: t0 + (timedelta(days=rng.randrange(900)) if whole_days else timedelta(microseconds=rng.randrange(10**14)))
    versions = []
    for n in range(900):
        k = rng.choice(["hot", "hot", "warm", None, "few"]) if n % 40 else f"k{n}"
        s = None if rng.random() < 0.03 else when()
        e = None if rng.random() < 0.1 else (s or t0) + timedelta(days=rng.choice([-2, 0, 1, 30, 800]))
        versions.append((k, s, e, rng.choice("abc"), rng.choice([None, 1.5, -2.0, 7.0]), rng.choice([True, False, None]), date(2020, 1, rng.randrange(1, 28))))
    bounds = [x for v in versions for x in v[1:3] if x]
    facts = [(n, rng.choice(["hot", "warm", "few", "k40", None, "nobody"]), rng.choice([None, when(), when(), rng.choice(bounds)]), "clash") for n in range(700)]
    return facts + facts[:30], versions


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("order", ORDERS)
def test_index_equals_the_direct_join(spark, order, closed):
    facts, versions = world(len(order), closed)
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    at = right.select("k", F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e"), *right.columns[3:])
    facts_at = left.withColumn("at", F.col("at").cast("timestamp_ntz"))
    values = ["v", "w", "flag", "day"]
    for how in ({}, {"fallback": [("day", False), ("v", True)]}):
        direct, indexed = (joins.best_interval(facts_at, at, "k", "at", "s", "e", order, values, closed=closed, most=m, **how) for m in (10**9, 3))
        assert direct.columns == indexed.columns and sorted(map(str, direct.collect())) == sorted(map(str, indexed.collect()))
    assert indexed.where("matched").count() > 50


def test_dates_and_empty_tables(spark):
    left = spark.sql("SELECT 1 AS id, 'a' AS k, DATE'2020-01-05' AS at UNION ALL SELECT 2, 'a', NULL UNION ALL SELECT 3, 'b', DATE'2020-01-05'")
    right = spark.sql("SELECT 'a' AS k, DATE'2020-01-01' AS s, DATE'2020-01-05' AS e, id AS v FROM range(10)")
    out = lambda a, b: sorted(tuple(r) for r in joins.best_interval(a, b, "k", "at", "s", "e", [("v", True)], ["v"], most=2).select("id", "v", "matched").collect())
    assert out(left, right) == [(1, 9, True), (2, None, False), (3, None, False)]
    assert out(left.limit(0), right) == [] and out(left, right.limit(0)) == [(1, None, False), (2, None, False), (3, None, False)]


def test_a_key_of_many_versions_takes_time_near_linear(spark):
    def took(n: int) -> float:
        base = spark.range(n).select(F.lit("hot").alias("k"), (F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("s"), F.col("id").alias("v"))
        versions = base.withColumn("e", F.col("s") + F.expr("INTERVAL 90 MINUTES"))
        facts = spark.range(n).select("id", F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 3600 + 1800).cast("timestamp_ntz").alias("at"))
        began = time.time()
        rows = joins.best_interval(facts, versions, "k", "at", "s", "e", [("v", True)], ["v"]).where("matched").agg(F.count("*"), F.sum(F.col("v") - F.col("id"))).first()
        assert tuple(rows) == (n, 0)
        return time.time() - began

    took(1_000)
    assert took(100_000) < 60  # all pairs would be 10 billion


def test_rows_meet_their_key_once_and_are_not_ranked(spark):
    """No window over what covers a row: rows move to their key, and nowhere else."""
    facts, versions = (spark.createDataFrame(x, s) for x, s in zip(world(3, True), (FACTS, VERSIONS)))
    out = joins.best_interval(facts, versions, "k", "at", "s", "e", [("w", False)], ["w"], fallback=[("w", True)], most=10**9)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 1


def test_nan_is_the_greatest_for_the_index_too(spark):
    left = spark.sql("SELECT 'a' AS k, DATE'2020-01-02' AS at")
    right = spark.sql("SELECT 'a' AS k, DATE'2020-01-01' AS s, DATE'2020-01-05' AS e, double(v) AS w, v FROM VALUES ('1'), ('NaN'), ('3') AS t(v)")
    for most in (10, 1):
        assert joins.best_interval(left, right, "k", "at", "s", "e", [("w", True)], ["w", "v"], most=most).first().v == "NaN"
