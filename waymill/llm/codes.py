"""Vectors as codes of their parts: product codebooks trained exactly by anchors-hierarchy trees.

Vectors are packed in blocks of a bounded number. In each block, each part position has its points in a metric tree
(``balls``), built once and kept in a written table. A training round sends the codebooks, a fixed few numbers, to the blocks;
balls owned by one entry give their cached sum, and the sums of all blocks are added up by part and entry before and in
one small exchange. No vector is shuffled, and which rows share a block or a task has no effect on any result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.llm.balls import Forest, forest, nearest_entries
from waymill.llm.common import cut_lineage, fresh, written
from waymill.llm.vectors import finite, matrix, whole

BLOCK = 4096
_FOREST = {"order": "int", "nodes": "int", "radius": "double", "sums": "bigint", "roots": "int"}


def _listed(values: np.ndarray) -> pa.ListArray:
    """All values in one row."""
    flat = np.ascontiguousarray(values).ravel()
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))


def points_of(vectors: np.ndarray, parts: int) -> np.ndarray:
    """All vectors' parts as points, position by position."""
    n, width = vectors.shape
    return np.ascontiguousarray(vectors.reshape(n, parts, width // parts).transpose(1, 0, 2)).reshape(n * parts, width // parts)


def blocks(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """A row for each block: ids, labels and vectors of its rows, and the trees over their parts."""
    kinds = dict(rows.dtypes)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                own = batch.slice(start, BLOCK)
                vectors = matrix(own.column("v"), width)
                ends = pa.array([0, len(own)], pa.int32())
                out = {c: pa.ListArray.from_arrays(ends, own.column(c)) for c in ("id", "label")} | {"v": _listed(vectors.astype(np.int32))}
                yield pa.RecordBatch.from_pydict(out | {c: _listed(x) for c, x in forest(points_of(vectors, parts), parts)._asdict().items()})

    schema = f"id array<{kinds['id']}>, label array<{kinds['label']}>, v array<int>, " + ", ".join(f"{c} array<{t}>" for c, t in _FOREST.items())
    return written(rows.mapInArrow(packed, schema))


def _unpacked(batch: pa.RecordBatch, row: int, parts: int, width: int) -> tuple[np.ndarray, Forest]:
    flat = lambda c: batch.column(c)[row].values.to_numpy(zero_copy_only=False)
    shapes = {"nodes": (-1, 4), "sums": (-1, width // parts)}
    return points_of(flat("v").astype(np.int64).reshape(-1, width), parts), Forest(**{c: flat(c).reshape(shapes.get(c, -1)) for c in _FOREST})


def _tally(books: np.ndarray, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """part, entry, n, s0, s1, ...: what a task's blocks add to each entry."""
    parts, each, own = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros((parts, each), dtype=np.int64), np.zeros((parts, each, own), dtype=np.int64)
        for batch in batches:
            for row in range(len(batch)):
                found = nearest_entries(*_unpacked(batch, row, parts, width), books)
                count += found.count
                sums += found.sums
        part, entry = np.nonzero(count)
        out = {"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(count[part, entry])}
        yield pa.RecordBatch.from_pydict(out | {f"s{k}": pa.array(sums[part, entry, k]) for k in range(own)})

    return run


def trained(packed: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after a round: componentwise floor of the mean of each entry's parts; unused entries stay."""
    own = books.shape[2]
    names = [f"s{k}" for k in range(own)]
    tally = packed.select("v", *_FOREST).mapInArrow(_tally(books, width), "part int, entry int, n bigint, " + ", ".join(f"{s} bigint" for s in names))
    out = books.copy()
    for r in tally.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():
        out[r.part, r.entry] = [r[s] // r.n for s in names]
    return out


def _coded(books: np.ndarray, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, each, own = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                points, trees = _unpacked(batch, row, parts, width)
                n = len(points) // parts
                entry = nearest_entries(points, trees, books).entry
                gap = points - books[np.repeat(np.arange(parts), n), entry]
                error = (gap * gap).sum(axis=1).reshape(parts, n).sum(axis=0)
                codes = [c.tobytes().hex() for c in np.ascontiguousarray(entry.reshape(parts, n).T.astype(np.uint8))]
                yield pa.RecordBatch.from_pydict({c: batch.column(c)[row].values for c in ("id", "label")} | {"code": pa.array(codes, pa.string()), "error": pa.array(error, pa.int64())})

    return run


def coded(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, width: int = 64, scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error of every kept row; the final codebooks: parts x entries x components).

    Rows whose vector is null or has a null or non-finite component are left out; one of another length than ``width`` can't be
    cut as the others are: it takes no part in training and has a null code and error. A component whose whole number is
    beyond 2^24 is an error. Codebooks start with the kept rows of least id, ties by vector, null ids after all others;
    with fewer rows they have fewer entries. At most 256 entries. Repeated rows count each.
    """
    if entries > 256 or width % parts:
        raise ValueError("a code has two hex digits a part, and parts are of equal width")
    rows = df.where(finite(vec_col)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(F.size(vec_col) == width, whole(vec_col, scale)).alias("v"))
    fit = rows.where("v IS NOT NULL")
    first = fit.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = np.array([r.v for r in first], dtype=np.int64).reshape(len(first), parts, width // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    packed = blocks(fit, parts, width)
    for _ in range(rounds):
        books = trained(packed, books, width)
    kinds = dict(rows.dtypes)
    out = packed.mapInArrow(_coded(books, width), f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")
    other = rows.where("v IS NULL").select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return out.unionByName(other), books


def code_report(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", **settings: int) -> DataFrame:
    """A row for each kept vector: id, code, error, label_error, codebooks_sha256 (see ``coded``)."""
    rows, books = coded(df, id_col, vec_col, label_col, **settings)
    rows = cut_lineage(rows)
    (of,) = (fresh("label"),)
    sums = rows.groupBy(F.col("label").alias(of)).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    met = rows.join(sums, F.col("label").eqNullSafe(F.col(of)), "left")
    return met.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
