"""Connected components of an edge table, as rounds of joins and groupings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.llm.common import cut_lineage

#: Edges of a task.
TASK_EDGES = 100_000


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")).first()
    return row.n, row.h


def stars(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b), b the least node that a reaches; nodes that are the least of theirs have no row.

    edges: columns a and b of one orderable type, either way round; loops, repeats and nulls are ignored.
    Alternates the large-star and small-star steps, each round from the shared folder on, until nothing
    changes; the number of rounds grows with the logarithm of the longest path. Tasks are as many as the edges of a round
    need, so that few edges don't leave a file for each pair of the session's shuffle partitions.
    """
    plain = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b AND a > b")
    now = cut_lineage(plain.distinct())
    before, state = None, _state(now)
    for _ in range(most_rounds):
        if state == before or not state[0]:
            return now
        tasks = math.ceil(state[0] / TASK_EDGES)
        now = now.coalesce(tasks)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).coalesce(tasks)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct().coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        joined = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, now = state, cut_lineage(low.select("a", F.col("m").alias("b")).unionByName(joined).distinct().coalesce(tasks))
        state = _state(now)
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
