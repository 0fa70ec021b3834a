"""Anchors-hierarchy metric trees over small sets of whole-number points, and exact nearest entries by them.

A set is first dealt to anchors, some square root of its size: each new anchor is the point farthest from its own, and
takes the points nearer to it; by the triangle inequality only points at over half the distance between two anchors can
change. Each anchor's points become a tree in the same way, and these trees are joined from the middle out to the
root, always the two whose common ball is smallest. A ball caches the sum and the count of its points.

Entries meet balls, not points. Going down, a ball inherits its parent's list of candidate entries, and drops those
that no point of it can be nearest to, nor equally near. A ball whose list has one entry is wholly owned: its cached
sum is that entry's, and its points aren't looked at. Lists that stay open to the last balls are settled point by point in whole
numbers, so results are exact.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np

#: Points that are not split further; point and entry pairs measured in one step.
LEAF, PAIRS = 32, 1 << 17


class Forest(NamedTuple):
    """Trees over disjoint rows of one table of points.

    order: rows such that a ball's are ``order[start:end]``; nodes: start, end, left, right (-1 where there is none) of each
    ball; radius around the mean; sums; roots: the ball of each tree.
    """

    order: np.ndarray
    nodes: np.ndarray
    radius: np.ndarray
    sums: np.ndarray
    roots: np.ndarray


def anchors(points: np.ndarray, count: int) -> np.ndarray:
    """Each point's anchor, of at most so many; fewer if the points are fewer different ones."""
    own = np.zeros(len(points), dtype=np.int64)
    pivots = points[:1]
    away = np.sqrt(((points - pivots[0]) ** 2).sum(axis=1))
    while len(pivots) < count:
        far = int(away.argmax())
        if away[far] == 0:
            break
        between = np.sqrt(((pivots - points[far]) ** 2).sum(axis=1))
        open_ = np.flatnonzero(2 * away > between[own] * (1 - 1e-9))
        there = np.sqrt(((points[open_] - points[far]) ** 2).sum(axis=1))
        nearer = there < away[open_]
        own[open_[nearer]], away[open_[nearer]] = len(pivots), there[nearer]
        pivots = np.concatenate([pivots, points[far : far + 1]])
    return own


class _Builder:
    def __init__(self, points: np.ndarray) -> None:
        self.points = points.astype(np.float64)
        self.rows: list[np.ndarray] = []
        self.children: list[tuple[int, int]] = []
        self.mean: list[np.ndarray] = []
        self.radius: list[float] = []

    def ball(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        own = self.points[rows]
        mean = own.sum(axis=0) / len(rows)
        self.rows.append(rows)
        self.children.append((left, right))
        self.mean.append(mean)
        self.radius.append(math.sqrt(((own - mean) ** 2).sum(axis=1).max()))
        return len(self.rows) - 1

    def tree(self, rows: np.ndarray) -> int:
        if len(rows) <= LEAF:
            return self.ball(rows)
        own = anchors(self.points[rows], max(2, math.isqrt(len(rows))))
        count = int(own.max()) + 1
        if count == 1:
            return self.ball(rows)
        by = np.argsort(own, kind="stable")
        return self.joined([self.tree(part) for part in np.split(rows[by], np.cumsum(np.bincount(own))[:-1])])

    def joined(self, balls: list[int]) -> int:
        """Pairs of smallest common ball, until there is one."""
        mean, radius = np.array([self.mean[b] for b in balls]), np.array([self.radius[b] for b in balls])

        def common(k: int) -> np.ndarray:
            apart = np.sqrt(((mean - mean[k]) ** 2).sum(axis=1))
            out = np.maximum(np.maximum(radius, radius[k]), (apart + radius + radius[k]) / 2)
            out[gone] = np.inf
            out[k] = np.inf
            return out

        gone = np.zeros(len(balls), dtype=bool)
        size = np.array([common(k) for k in range(len(balls))])
        for _ in range(len(balls) - 1):
            a, b = sorted(divmod(int(size.argmin()), len(balls)))
            balls[a] = self.ball(np.concatenate([self.rows[balls[a]], self.rows[balls[b]]]), balls[a], balls[b])
            mean[a], radius[a], gone[b] = self.mean[balls[a]], self.radius[balls[a]], True
            size[b], size[:, b] = np.inf, np.inf
            size[a] = size[:, a] = common(a)
        return balls[int(np.flatnonzero(~gone)[0])]


def forest(points: np.ndarray, trees: int) -> Forest:
    """Trees over equal consecutive shares of the points."""
    build, roots, share = _Builder(points), [], len(points) // trees
    for t in range(trees):
        roots.append(build.tree(np.arange(t * share, (t + 1) * share)))
    nodes = np.full((len(build.rows), 4), -1, dtype=np.int32)
    order, at, stack = [], 0, list(reversed(roots))
    while stack:  # leaves from left to right
        k = stack.pop()
        left, right = build.children[k]
        nodes[k, :2], nodes[k, 2:] = (at, at + len(build.rows[k])), (left, right)
        if left < 0:
            order.append(build.rows[k])
            at += len(build.rows[k])
        else:
            stack += [right, left]
    sums = np.array([points[rows].sum(axis=0) for rows in build.rows], dtype=np.int64)
    return Forest(np.concatenate(order).astype(np.int32), nodes, np.array(build.radius), sums, np.array(roots, dtype=np.int32))


class Found(NamedTuple):
    """Of each tree's entries the count and the sum of their points; each point's entry; how many points were looked at."""

    count: np.ndarray
    sums: np.ndarray
    entry: np.ndarray
    looked_at: int


def nearest_entries(points: np.ndarray, trees: Forest, entries: np.ndarray) -> Found:
    """The nearest entry of every point, ties to the lower one. entries: (trees, entries, components)."""
    of, each, width = entries.shape
    entry = np.zeros(len(points), dtype=np.int64)
    counts, sums = np.zeros((of, each), dtype=np.int64), np.zeros((of, each, width), dtype=np.int64)
    ball, tree = trees.roots.astype(np.int64), np.arange(of)
    listed = np.ones((of, each), dtype=bool)
    sizes = trees.nodes[:, 1] - trees.nodes[:, 0]
    wide, looked_at = entries.astype(np.float64), 0
    while len(ball):
        mean = trees.sums[ball] / sizes[ball, None]
        away = np.sqrt(((mean[:, None, :] - wide[tree]) ** 2).sum(axis=2))
        away[~listed] = np.inf
        reach = trees.radius[ball]
        limit = (away.min(axis=1) + 2 * reach) * (1 + 1e-9) + 1e-6
        listed &= away <= limit[:, None]
        one = listed.sum(axis=1) == 1
        if one.any():
            owner = listed[one].argmax(axis=1)
            np.add.at(counts, (tree[one], owner), sizes[ball[one]])
            np.add.at(sums, (tree[one], owner), trees.sums[ball[one]])
            entry[trees.order[_ranges(trees.nodes[ball[one], 0], sizes[ball[one]])]] = np.repeat(owner, sizes[ball[one]])
        left = trees.nodes[ball, 2]
        last = ~one & (left < 0)
        if last.any():
            n = sizes[ball[last]]
            rows = trees.order[_ranges(trees.nodes[ball[last], 0], n)].astype(np.int64)
            found = _settled(points, rows, np.repeat(tree[last], n), entries, np.repeat(listed[last], n, axis=0))
            entry[rows] = found
            np.add.at(counts, (np.repeat(tree[last], n), found), 1)
            np.add.at(sums, (np.repeat(tree[last], n), found), points[rows])
            looked_at += len(rows)
        on = ~one & (left >= 0)
        ball = np.concatenate([trees.nodes[ball[on], 2], trees.nodes[ball[on], 3]]).astype(np.int64)
        tree, listed = np.concatenate([tree[on]] * 2), np.concatenate([listed[on]] * 2)
    return Found(counts, sums, entry, looked_at)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def _settled(points: np.ndarray, rows: np.ndarray, tree: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The nearest of each row's listed entries in whole numbers, ties to the lower one."""
    out, step = np.empty(len(rows), dtype=np.int64), max(1, PAIRS // listed.shape[1])
    for k in range(0, len(rows), step):
        row, col = np.nonzero(listed[k : k + step])
        gap = points[rows[k : k + step][row]] - entries[tree[k : k + step][row], col]
        away = np.full((len(out[k : k + step]), listed.shape[1]), np.iinfo(np.int64).max)
        away[row, col] = (gap * gap).sum(axis=1)
        out[k : k + step] = away.argmin(axis=1)
    return out
