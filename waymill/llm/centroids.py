"""Exact k-means over whole-number vectors with ns-bounds.

Every vector keeps a lower bound of its distance to each centroid and the round that the bound was measured in.
The centroids of all rounds are kept, some thousand numbers, so a bound is loosened by the norm of the centroid's
total displacement since that round; steps that go back and forth cost nothing, as they would if drifts were
added up. Where a bound is over the distance to the own centroid, that centroid can't be nearer nor equally near,
and is not looked at. All others are measured again, in whole numbers, so every assignment is exact.

A round is one pass over a written table without any shuffle of vectors: tasks read vectors and bounds, write
them with new bounds, and Spark adds up the sums of each cluster before it exchanges them. The driver holds only
the centroids of each round. Which rows share a task has no effect, so lost tasks give the same rows again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.llm.common import written
from waymill.llm.vectors import finite, matrix, whole

#: Vector and centroid pairs that are measured in one step.
PAIRS = 1 << 15


class State(NamedTuple):
    """Of some vectors: the cluster, its squared distance, lower bounds of all distances, the rounds they are of."""

    cluster: np.ndarray
    distance: np.ndarray
    low: np.ndarray
    at: np.ndarray


def squared(vectors: np.ndarray, centroids: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact squared distances of pairs."""
    out = np.empty(len(rows), dtype=np.int64)
    for k in range(0, len(rows), PAIRS):
        gap = vectors[rows[k : k + PAIRS]] - centroids[cols[k : k + PAIRS]]
        out[k : k + PAIRS] = np.einsum("ij,ij->i", gap, gap)
    return out


def rounded_down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-1))


def assign(vectors: np.ndarray, history: np.ndarray, state: State | None = None) -> tuple[State, int]:
    """The nearest of the last centroids of the history, ties to the smaller number, and how many pairs were measured.

    history: (rounds so far, centroids, components); state: from any earlier round of it, or none.
    """
    count, n, now = history.shape[1], len(vectors), len(history) - 1
    each = np.arange(n)
    if state is None:
        rows, cols = np.divmod(np.arange(n * count), count)
        low, at = np.zeros((n, count), dtype=np.float32), np.zeros((n, count), dtype=np.int16)
    else:
        own = squared(vectors, history[now], each, state.cluster)
        moved = np.sqrt(((history - history[now]) ** 2).sum(axis=2, dtype=np.float64))
        low, at = state.low.copy(), state.at.copy()
        reach = np.sqrt(own.astype(np.float64)) * (1 + 1e-9) + 1e-6
        open_ = low - moved[at, np.arange(count)] <= reach[:, None]
        open_[each, state.cluster] = True
        rows, cols = np.nonzero(open_)
    measured = squared(vectors, history[now], rows, cols)
    low[rows, cols], at[rows, cols] = rounded_down(np.sqrt(measured.astype(np.float64))), now
    found = np.full((n, count), np.iinfo(np.int64).max)
    found[rows, cols] = measured
    cluster = found.argmin(axis=1)
    return State(cluster, found[each, cluster], low, at), len(rows)


def _step(history: np.ndarray, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, width = history.shape[1:]
        for batch in batches:
            if not len(batch):
                continue
            vectors, before = matrix(batch.column("v"), width), None
            if "cluster" in batch.schema.names:
                lists = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, count) for c in ("low", "at")]
                before = State(batch.column("cluster").to_numpy().astype(np.int64), np.zeros(0), *lists)
            state, _ = assign(vectors, history, before)
            out = {"id": batch.column("id"), "cluster": pa.array(state.cluster, pa.int32()), "distance": pa.array(state.distance, pa.int64())}
            if not last:
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, count), pa.int32()), pa.array(x.ravel()))
                out |= {"v": batch.column("v"), "low": lists(state.low), "at": lists(state.at)}
            yield pa.RecordBatch.from_pydict(out)

    return run


def means(rows: DataFrame, before: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each cluster, exact; empty clusters stay where they were."""
    width = before.shape[1]
    sums = [F.sum(F.element_at("v", i + 1)).alias(f"s{i}") for i in range(width)]
    out = before.copy()
    for r in rows.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(width)]
    return out


def clustered(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", count: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: str = "1") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance of every kept row; the final centroids).

    Rows whose vector is null, has not ``width`` components, or has a null or non-finite one are left out; a component
    whose whole number is beyond 2^24 is an error. The first centroids are the kept rows of least sha256 of
    ``seed:id``, ties by their vectors; rows with a null id come after all others. Repeated rows count each. With fewer
    rows than ``count`` there are as many centroids as rows. Other columns play no part.
    """
    kept = df.where(finite(vec_col) & (F.size(vec_col) == width))
    now = written(kept.select(F.col(id_col).alias("id"), whole(vec_col, scale).alias("v")))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = now.orderBy(name.asc_nulls_last(), "v").select("v").limit(count).collect()
    history = np.array([r.v for r in first], dtype=np.int64).reshape(1, len(first), width)
    kind = f"id {dict(now.dtypes)['id']}, cluster int, distance bigint"
    for left in range(rounds, -1, -1):
        state = kind if not left else f"{kind}, v array<bigint>, low array<float>, at array<smallint>"
        now = written(now.mapInArrow(_step(history, last=not left), state))
        if left:
            history = np.concatenate([history, means(now, history[-1])[None]])
    return now, history[-1]


def cluster_report(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **settings: int | str) -> DataFrame:
    """A row for each kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256 (see ``clustered``)."""
    rows, centroids = clustered(df, id_col, vec_col, **settings)
    own = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    table = [(c, s, sum(own.values()), digest(c)) for c, s in sorted(own.items())]
    told = df.sparkSession.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.withColumnRenamed("id", id_col).join(F.broadcast(told), "cluster")
