"""SimHash fingerprints, and their exact neighbours by vantage-point trees.

Distinct fingerprints are the points; copies of a text share one. A tree splits points by their Hamming
distance, over a block of bits, from vantage points: at most a radius, or beyond. Distance over a block is
a metric too, and of two fingerprints within ``distance`` bits at least one block differs in at most
``distance // blocks`` bits. So by the triangle bound a search with that slack, in the tree of each block,
meets every linked pair: a point lives in one shard, and is a query in each shard whose bounds its slack
overlaps; the branches that the bound rules out are never visited. With two blocks of 32 bits (the default)
the slack for 3 bits is one, and a query goes on to neighbouring shards where it lies at their boundary.

A shard's work is its own points against its queries. Both are sorted by full distance from one more vantage
point, and only those within ``distance`` of each other there are compared. Points and queries over a size are
cut into parts, and a part of points with a part of queries is a task's work. Each gives a spanning forest of
the links that it finds, never all pairs.

Null and wordless texts have fingerprint zero, linked like any other. Repeated rows and equal ids are kept
as they are; a null id never becomes a component's id unless all its ids are null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.llm.common import cut_lineage, fresh
from waymill.llm.components import stars

BITS, SEED, SHINGLE = 64, 42, 3
#: Points that a shard should hold; points or queries of a task's work; blocks of bits, one tree each.
SHARD, CELL, BLOCKS = 512, 8192, 2
#: Fingerprints that the trees are fitted on: some for each shard, at least and at most so many.
FIT, LEAST_FIT, MOST_FIT = 8, 4096, 1 << 18
#: Shingles that are counted in one step; lanes of 16 bits hold that many.
STEP = 60_000
_LANES = np.array([sum(((n >> j) & 1) << (16 * j) for j in range(4)) for n in range(16)], dtype=np.uint64)


def shingle_hashes(text: str) -> list[int]:
    words = text.encode("utf-8").lower().split()
    if len(words) > SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(words, words[1:], words[2:])]
    return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []


def bit_majority(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """uint64 per text: the bits set in over half of its hashes, which lie one text after the other."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    starts, owner, at = [], [], 0
    for i, n in enumerate(sizes):
        for begin in range(at, at + n, STEP):
            starts.append(begin)
            owner.append(i)
        at += n
    if not starts:
        return out
    ends, parts, i = [*starts[1:], len(hashes)], [], 0
    while i < len(starts):  # some hashes at once, as each takes 128 bytes here
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + STEP)))
        digits = hashes[starts[i] : ends[j - 1]].astype("<u8").view(np.uint8).reshape(-1, 8)
        lanes = np.empty((len(digits), 16), dtype=np.uint64)
        lanes[:, 0::2], lanes[:, 1::2] = _LANES[digits & 15], _LANES[digits >> 4]
        parts.append(np.add.reduceat(lanes, np.array(starts[i:j]) - starts[i], axis=0))
        i = j
    sums = np.concatenate(parts)
    counts = ((sums[:, :, None] >> np.arange(0, 64, 16, dtype=np.uint64)) & np.uint64(0xFFFF)).reshape(-1, BITS).astype(np.int64)
    owners, first = np.unique(owner, return_index=True)
    counts = np.add.reduceat(counts, first, axis=0)
    over = 2 * counts > np.asarray(sizes, dtype=np.int64)[owners][:, None]
    out[owners] = (over.astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def fingerprint(text: Column) -> Column:
    """The 64-bit fingerprint of a text column as bigint (its bits, read as a signed number)."""

    @F.pandas_udf("long")
    def mark(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            done, hashes, sizes = [], [], []
            for text in batch:
                own = shingle_hashes(text or "")
                hashes += own
                sizes.append(len(own))
                if len(hashes) > STEP:
                    done.append(bit_majority(np.array(hashes, dtype=np.uint64), sizes))
                    hashes, sizes = [], []
            done.append(bit_majority(np.array(hashes, dtype=np.uint64), sizes))
            yield pd.Series(np.concatenate(done).view(np.int64))

    return mark(text)


def block_mask(block: int, blocks: int) -> int:
    low, high = BITS * block // blocks, BITS * (block + 1) // blocks
    return ((1 << high) - 1) ^ ((1 << low) - 1)


class Split(NamedTuple):
    """A node: points within ``radius`` of ``vantage`` over the tree's block go ``near``; None is a shard."""

    vantage: int
    radius: int
    near: Split | None
    far: Split | None


def plant(points: np.ndarray, mask: int, depth: int) -> Split | None:
    """A tree over a sample: of a few vantage points, the one whose best radius halves the points most evenly."""
    if depth == 0 or len(points) < 2:
        return None
    best = None
    for vantage in points[:: max(1, len(points) // 8)][:8]:
        away = np.bitwise_count((points ^ vantage) & np.uint64(mask))
        below = np.cumsum(np.bincount(away, minlength=BITS + 1))
        radius = int(np.abs(2 * below - len(points)).argmin())
        uneven = abs(2 * int(below[radius]) - len(points))
        if best is None or uneven < best[0]:
            best = (uneven, int(vantage), radius, away <= radius)
    _, vantage, radius, near = best
    if near.all():
        return None
    return Split(vantage, radius, plant(points[near], mask, depth - 1), plant(points[~near], mask, depth - 1))


def shards_of(points: np.ndarray, tree: Split | None, mask: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of points and the shards they reach; shards are numbered by the path, 1 then a bit a level."""
    found: list[tuple[np.ndarray, int]] = []
    todo = [(tree, np.arange(len(points)), 1)]
    while todo:
        node, at, path = todo.pop()
        if node is None or not len(at):
            found.append((at, path))
            continue
        away = np.bitwise_count((points[at] ^ np.uint64(node.vantage)) & np.uint64(mask)).astype(np.int64)
        todo.append((node.near, at[away - slack <= node.radius], 2 * path))
        todo.append((node.far, at[away + slack > node.radius], 2 * path + 1))
    return np.concatenate([a for a, _ in found]), np.concatenate([np.full(len(a), p, dtype=np.int64) for a, p in found])


def forest(own: np.ndarray, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (point, root) that connect a shard's own points and queries as their links of at most ``distance`` bits do."""
    nodes = np.union1d(own, queries)
    vantage = own[0]
    away, asked = (np.bitwise_count(x ^ vantage).astype(np.int64) for x in (own, queries))
    order, ask = np.argsort(away, kind="stable"), np.argsort(asked, kind="stable")
    own, away, queries, asked = own[order], away[order], queries[ask], asked[ask]
    hits = [(np.zeros(0, dtype=np.int64),) * 2]
    for start in range(0, len(queries), 256):
        end = min(start + 256, len(queries))
        low = int(np.searchsorted(away, asked[start] - distance))
        high = int(np.searchsorted(away, asked[end - 1] + distance, side="right"))
        q, o = np.nonzero(np.bitwise_count(queries[start:end, None] ^ own[None, low:high]) <= distance)
        other = queries[start + q] != own[low + o]
        hits.append((start + q[other], low + o[other]))
    a, b = np.searchsorted(nodes, queries[np.concatenate([h[0] for h in hits])]), np.searchsorted(nodes, own[np.concatenate([h[1] for h in hits])])
    label = np.arange(len(nodes))
    while (label[a] != label[b]).any():
        least = np.minimum(label[a], label[b])
        for end in (label[a], label[b]):  # roots first, so that whole groups move
            np.minimum.at(label, end, least)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label[label] != label).any():
            label = label[label]
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def gathered(batches: Iterator[pd.DataFrame], least: int = 1 << 16) -> Iterator[np.ndarray]:
    """The points of a task, so many at a time: a walk through a tree pays for many at once."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(batch["fp"].to_numpy().view(np.uint64))
        if sum(map(len, held)) >= least:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def links(points: DataFrame, distance: int = 3, blocks: int | None = None, shard: int = SHARD, cell: int = CELL) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints (column fp) within ``distance`` bits.

    blocks: bits are cut into that many, one tree each. With more blocks than ``distance`` no query needs a
    second shard, but shards hold whatever agrees in few bits; with fewer, shards are finer and queries visit
    neighbouring ones.
    """
    blocks = blocks or BLOCKS
    slack = distance // blocks
    count = points.count()
    shards = max(1, math.ceil(count / shard))
    fitted = points.orderBy(F.xxhash64("fp"), "fp").limit(min(MOST_FIT, max(LEAST_FIT, FIT * shards)))
    seen = np.array([r.fp for r in fitted.collect()], dtype=np.int64).view(np.uint64)
    depth = math.ceil(math.log2(shards))
    masks = [block_mask(b, blocks) for b in range(blocks)]
    trees = [plant(seen, m, depth) for m in masks]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in gathered(batches):
            for b, (tree, mask) in enumerate(zip(trees, masks)):
                homes, home = shards_of(own, tree, mask, 0)
                home_of = np.empty(len(own), dtype=np.int64)
                home_of[homes] = home
                at, path = shards_of(own, tree, mask, slack) if slack else (homes, home)
                yield pd.DataFrame({"tree": np.int32(b), "shard": path, "fp": own[at].view(np.int64), "lives": home_of[at] == path})

    routed = cut_lineage(points.select("fp").mapInPandas(route, "tree int, shard long, fp long, lives boolean"))
    parts = lambda n: F.ceil(n / cell).cast("int")
    sizes = routed.groupBy("tree", "shard").agg(parts(F.count_if("lives")).alias("owns"), parts(F.count("*")).alias("asks")).where("owns > 0")
    met = routed.join(sizes, ["tree", "shard"])
    part = lambda n: F.pmod(F.xxhash64("fp"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = met.select("tree", "shard", "fp", F.lit(False).alias("owned"), every("owns").alias("row"), part(F.col("asks")).alias("col"))
    owned = met.where("lives").select("tree", "shard", "fp", F.lit(True).alias("owned"), part(F.col("owns")).alias("row"), every("asks").alias("col"))

    def connect(group: pd.DataFrame) -> pd.DataFrame:
        own, queries = (group.loc[group["owned"] == x, "fp"].to_numpy().view(np.uint64) for x in (True, False))
        a, b = forest(own, queries, distance) if len(own) and len(queries) else (own[:0], own[:0])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return owned.unionByName(asking).groupBy("tree", "shard", "row", "col").applyInPandas(connect, "a long, b long")


def marked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3, blocks: int | None = None) -> DataFrame:
    """id, fp, root (least fp of the component), component_id (least id), for each row."""
    docs = cut_lineage(df.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp")))
    return rooted(docs, lambda points: links(points, distance, blocks))


def rooted(docs: DataFrame, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows (id, fp) with root and component_id, by the edges that ``link`` finds for the distinct fp."""
    points = cut_lineage(docs.groupBy("fp").agg(F.min("id").alias("id")))
    roots = stars(link(points))
    joined = points.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "id", F.coalesce("b", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("id").alias("component_id"))
    named = joined.join(least, "root").select("fp", "root", "component_id")
    return docs.join(named, "fp").select("id", "fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3, blocks: int | None = None) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of every row."""
    return marked(df, id_col, text_col, distance, blocks).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3) -> DataFrame:
    """One row of each component: that of the least id, null ids after all others, ties by fingerprint and then by a hash
    of the whole row, so that the order of rows doesn't matter. Rows of one id are judged each by its own text."""
    return first_rows(df, marked(df, id_col, text_col, distance), fingerprint, id_col, text_col)


def first_rows(df: DataFrame, marks: DataFrame, mark: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """What ``keep_first`` keeps, by the marked rows; ``mark`` gives a text's fp. Texts of ids that one row has travel nowhere."""
    found = cut_lineage(marks)
    key, own, row = fresh("id"), fresh("fp"), fresh("row")
    rows_of = found.groupBy(F.col("id").alias(key)).agg(F.count("*").alias("n"))
    least = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("c")).select("c.id", "c.fp")
    chosen = cut_lineage(least.join(rows_of, F.col("id").eqNullSafe(F.col(key))).select(key, F.col("fp").alias(own), (F.col(key).isNotNull() & (F.col("n") == 1)).alias("alone")))
    alone = df.join(chosen.where("alone").select(key), df[id_col] == F.col(key), "left_semi")
    several = chosen.where("NOT alone").select(key, F.col(own).alias(own + "_"))
    if several.isEmpty():
        return alone
    unsure = df.join(several.select(key).distinct(), df[id_col].eqNullSafe(F.col(key)), "left_semi").withColumn(own, mark(F.col(text_col)))
    met = unsure.join(several, unsure[id_col].eqNullSafe(F.col(key)) & (F.col(own) == F.col(own + "_")), "left_semi")
    told = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map")]
    one = met.groupBy(id_col, own).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.xxhash64(*told)).alias(row))
    return alone.unionByName(one.select(*[F.col(f"{row}.{c}").alias(c) for c in df.columns]))
