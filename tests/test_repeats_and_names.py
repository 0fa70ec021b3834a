"""Repeated keys, names that clash, deep trees, counts in one pass, pseudonyms of full shapes."""

import itertools
import time

import pytest
from pyspark.sql import functions as F

from waymill.operators import dedupe, joins, kpi, lookup, merge, synth, timeseries


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_settles_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", 1)], "k int, v string, n int")
    incoming = spark.createDataFrame([(1, "b", 5), (1, "c", 5), (3, "d", 1), (None, "x", 0)], "k int, v string, n int")
    with pytest.raises(Exception, match="incoming key is not unique: 1"):
        merge.upsert(target, incoming, ["k"], "overwrite").collect()
    assert rows(merge.upsert(target, incoming, ["k"], "overwrite", repeated="agree")) == [(1, "a", 5), (2, "b", 1), (3, "d", 1)]
    assert rows(merge.upsert(target, incoming, ["k"], "overwrite", repeated=[F.desc("v")])) == [(1, "c", 5), (2, "b", 1), (3, "d", 1)]


def test_versions_of_repeated_keys_and_equal_bounds(spark):
    schema = "k int, s date, e date, v string, __stored string"
    target = spark.sql("SELECT 1 AS k, DATE'2020-01-01' AS s, CAST(NULL AS DATE) AS e, 'b' AS v, 'x' AS __stored UNION ALL SELECT 1, DATE'2020-01-01', NULL, 'a', 'x'")
    incoming = spark.sql("SELECT 1 AS k, DATE'2021-01-01' AS s, CAST(NULL AS DATE) AS e, 'c' AS v, 'y' AS __stored UNION ALL SELECT 1, DATE'2021-01-01', NULL, 'd', 'y'")
    with pytest.raises(Exception, match="not unique"):
        merge.new_versions(target, incoming, ["k"], "s", "e", {"v": "text"}).collect()
    out = merge.new_versions(target, incoming, ["k"], "s", "e", {"v": "text"}, repeated=[F.asc("v")])
    assert [(r.v, str(r.e)) for r in out.orderBy("v").collect()] == [("a", "2021-01-01"), ("b", "None"), ("c", "None")]
    assert len(schema.split(",")) == len(out.columns)


def test_enrich_holds_rows_and_clashing_names(spark):
    left = spark.createDataFrame([(1, None, "x"), (2, "own", "y"), (None, None, "z")], "k int, v string, __v string")
    right = spark.createDataFrame([(1, "new"), (2, "other"), (None, "n1"), (None, "n2")], "k int, v string")
    assert rows(joins.enrich(left, right, ["k"], ["v"])) == [(1, "new", "x"), (2, "own", "y"), (None, None, "z")]
    with pytest.raises(Exception, match="key is not unique: 1"):
        joins.enrich(left, right.union(right.where("k = 1")), ["k"], ["v"]).collect()


def test_internal_names_clash_with_no_column(spark):
    df = spark.sql("SELECT 'k' AS k, TIMESTAMP_NTZ'2020-01-01 00:00:00' AS a, TIMESTAMP_NTZ'2020-01-02 00:00:00' AS b, 'x' AS __s, 'y' AS __e, 'z' AS __start")
    out = timeseries.merged_intervals(df, ["k"], "a", "b", keep=["__s", "__start"]).first()
    assert (out["__s"], out["__start"]) == ("x", "z")
    latest = dedupe.latest_per_column(spark.sql("SELECT 1 AS k, DATE'2020-01-01' AS at, 'x' AS __at, 'y' AS v"), ["k"], "at", {"__at": "max", "v": "max"}).first()
    assert (latest["__at"], latest.v) == ("x", "y")
    mapped = lookup.mapped(spark.sql("SELECT 'a' AS v, 'kept' AS __key, 'kept' AS __value"), "v", spark.sql("SELECT 'a' AS k, 'b' AS w"), "k", "w").first()
    assert (mapped.v, mapped["__key"], mapped["__value"]) == ("b", "kept", "kept")
    moved = synth.remapped_keys(spark.sql("SELECT 1 AS k, 'kept' AS __old"), spark.sql("SELECT 1 AS a, 9 AS b"), "k", "a", "b").first()
    assert (moved.k, moved["__old"]) == (9, "kept")
    flags = merge.duplicate_flags(spark.sql("SELECT 'a' AS k, 'kept' AS __k"), spark.sql("SELECT 'a' AS k, 7 AS id"), ["k"], "id").first()
    assert (flags.stored_id, flags["__k"]) == (7, "kept")


def test_a_chain_of_ten_thousand_levels(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(joins, "materialised", lambda df, own=joins.materialised: counted.append(1) or own(df))
    chain = spark.range(10_000).select("id", F.lit("x").alias("name"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    out = joins.paths(chain, "id", "name", "parent", mark=">")
    assert len(counted) < 20 and out.agg(F.count("*"), F.max("depth"), F.max(F.length("path"))).first() == (10_000, 10_000, 19_999)


def test_circles_orphans_and_two_parents(spark):
    nodes = [("r", "R", None), ("a", "A", "r"), ("b", "B", "a"), ("c1", "C1", "c2"), ("c2", "C2", "c1"), ("d", "D", "c1"), ("o", "O", "gone"), ("two", "T", "a"), ("two", "T", "r"), ("t", "U", "two")]
    df = spark.createDataFrame(nodes, "id string, name string, parent string")
    want = [("a", "R > A", 2), ("b", "R > A > B", 3), ("r", "R", 1), ("t", "R > A > T > U", 4), ("t", "R > T > U", 3), ("two", "R > A > T", 3), ("two", "R > T", 2)]
    assert rows(joins.paths(df, "id", "name", "parent")) == sorted(want, key=str)


def test_five_counts_are_one_pass_without_expand(spark):
    ids = list(kpi.COUNTED.values())
    facts = spark.range(300).select((F.col("id") % 3).alias("p"), F.lit(1.5).alias("price"), *[F.when(F.col("id") % (k + 2) != 0, (F.col("id") % (7 + k)).cast("string" if k % 2 else "long")).alias(c) for k, c in enumerate(ids)])
    formulas = {n: kpi.leaf(n) for n in kpi.COUNTED} | {"price": kpi.leaf("vehicle-price")}
    out = kpi.evaluate(facts, ["p"], formulas)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    want = facts.groupBy("p").agg(*[F.count_distinct(c).cast("double").alias(n) for n, c in kpi.COUNTED.items()], F.sum("price").alias("price"))
    assert rows(out) == rows(want) and out.columns == want.columns
    assert rows(kpi.evaluate(facts, [], formulas)) == rows(facts.agg(*[F.count_distinct(c).cast("double").alias(n) for n, c in kpi.COUNTED.items()], F.sum("price")))
    nothing = facts.withColumns({c: F.lit(None).cast("long") for c in ids}).withColumn("p", F.lit(None).cast("long"))
    assert rows(kpi.evaluate(nothing, ["p"], {"n": kpi.leaf("total-users"), "price": kpi.leaf("vehicle-price")})) == [(None, 0.0, 450.0)]


def test_the_permutation_is_one_of_all_texts_of_a_shape(spark):
    for shape, n in (("A0", 260), ("A-0A", 6760), ("0", 10), ("A00", 2600)):
        df = synth.texts_of(spark, shape, "t").withColumn("alias", synth.permuted(F.col("t"), 7))
        assert df.agg(F.count("*"), F.count_distinct("t"), F.count_distinct("alias")).first() == (n, n, n)
        assert df.where(synth.shape_of(F.col("alias")) != shape).count() == 0
    assert synth.texts_of(spark, "A0", "t").where(synth.permuted(F.col("t"), 7) != F.col("t")).count() > 200
    one = spark.createDataFrame([("--",), ("x",)], "t string").select(synth.permuted(F.col("t"), 1)).collect()
    assert one[0][0] is None and one[1][0].isupper()


@pytest.mark.parametrize("free", [0, 3])
def test_pseudonyms_of_a_full_shape(spark, free):
    every = [a + d for a, d in itertools.product(synth.LETTERS, synth.DIGITS)]
    keys, taken = every, [x for x in every[free:] if free]  # all keys, nothing taken; then more keys than are free
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    used = spark.createDataFrame([(k,) for k in taken], "k string")
    if free:
        with pytest.raises(ValueError, match="fewer free pseudonyms"):
            synth.unique_pseudonyms(df, "k", used)
        few = rows(synth.unique_pseudonyms(df.where("k IN ('B7', 'Z9', 'C0')"), "k", used))
        assert {a for _, a in few} == set(every[:3]) and len(few) == 3
    else:
        assert sorted(r.alias for r in synth.unique_pseudonyms(df, "k", used).collect()) == sorted(every)


def test_pseudonyms_that_are_taken_walk_on(spark):
    keys = [f"{a}{b:02d}" for a in "ABCDEFGHIJ" for b in range(30)]  # 300 of 2600, all of them taken
    df = spark.createDataFrame([(k,) for k in [*keys, "a00", "Élan 7", None, keys[0]]], "k string")
    began = time.time()
    out = rows(synth.unique_pseudonyms(df, "k", df, seed=5))
    assert len(out) == 302 and len({a for _, a in out}) == 302 and not {a for _, a in out} & set(keys)
    assert out == rows(synth.unique_pseudonyms(df, "k", df, seed=5)) and time.time() - began < 120
