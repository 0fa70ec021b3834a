"""Names with many copies: a task makes the pairs of two chunks a part at a time."""

from pyspark.sql import functions as F

from tests.test_similar_names import brute
from waymill.operators import alike, joins


def test_slices_equal_all_pairs(spark, monkeypatch):
    for name, value in (("CHUNK", 8), ("SLICE", 3)):
        monkeypatch.setattr(alike, name, value)
    names = ["hot ring brand#1"] * 20 + ["hot ring brand#12"] * 5 + ["ring"] * 7 + ["rings"] * 4 + ["brand#1 ring hot"] * 9 + ["cold rod brand#7"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    found = [tuple(r) for r in joins.similar_names(df, "id", "name", 75.0).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(names, 75.0)


def made(plan) -> int:
    """Most rows that a step of the plan has made."""
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.metrics().apply("numOutputRows").value()] if plan.nodeName() == "Generate" else []
    return max([*own, *map(made, below)], default=0)


def test_pairs_of_large_chunks_are_not_held_at_once(spark):
    n = alike.CHUNK
    ids = lambda first: F.sequence(F.col("id") + first, F.col("id") + first + n - 1)
    chunks = spark.range(0, 1, 1, 1).select(F.lit(False).alias("same"), F.lit(99.0).alias("forth"), F.lit(99.0).alias("back"), ids(0).alias("ids_x"), ids(n).alias("ids_y"))
    first = alike.paired(chunks, 95.0).limit(1)
    assert len(first.collect()) == 1
    assert 0 < made(first._jdf.queryExecution().executedPlan()) <= 100_000
    out = alike.paired(chunks, 95.0)
    assert tuple(out.agg(F.count("*"), F.count_distinct("id_a"), F.count_distinct("id_b"), F.max("id_a"), F.min("id_b")).first()) == (n * n, n, n, n - 1, n)
