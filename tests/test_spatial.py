"""Nearest places against all pairs: clusters, gaps, repeated and null points, ties."""

import math
import random

import pytest

from waymill.operators import spatial


def plain(points, places):
    ok = lambda x, y: x is not None and y is not None and math.isfinite(x) and math.isfinite(y)
    spots = [p for p in places if ok(*p[1:])]
    out = []
    for i, x, y in points:
        if ok(x, y) and spots:
            d, name = min((math.sqrt((px - x) ** 2 + (py - y) ** 2), name) for name, px, py in spots)
            out.append((i, name, d))
    return out


def world(seed: int):
    rng = random.Random(seed)
    hubs = [(0, 0, 1e-4), (0.001, 0.001, 1e-7), (50, -20, 0.5), (-1e6, 3e5, 10), (7, 7, 0)]
    at = lambda: (lambda h: (h[0] + rng.gauss(0, 1) * h[2], h[1] + rng.gauss(0, 1) * h[2]))(rng.choice(hubs))
    places = [(f"p{n:04d}", *at()) for n in range(1500)] + [("none", None, 1.0), ("nan", float("nan"), 0.0), ("inf", 0.0, float("inf")), ("a", 3.0, 4.0), ("b", 3.0, 4.0), ("left", -1.0, 100.0), ("right", 1.0, 100.0)]
    points = [(n, *(at() if n % 5 else (rng.uniform(-2e6, 2e6), rng.uniform(-2e6, 2e6)))) for n in range(800)]
    points += [(1, 3.0, 4.0), (1, 60.0, -20.0), (None, 0.0, 0.0), (None, 0.0, 0.0), (5, 0.0, 100.0), (6, None, 0.0), (7, 1.0, float("-inf"))]
    return points, places


@pytest.mark.parametrize(("seed", "sorted_at_once"), [(1, 200_000), (2, 300)])
def test_nearest_equals_all_pairs(spark, monkeypatch, seed, sorted_at_once):
    monkeypatch.setattr(spatial, "SORTED", sorted_at_once)
    points, places = world(seed)
    p = spark.createDataFrame([(*r, "clash") for r in points], "id long, x double, y double, row string").repartition(3)
    q = spark.createDataFrame([(*r, 1) for r in places], "place string, px double, py double, leaf int").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted((tuple(r) for r in spatial.nearest(p, q, "id", "x", "y", "place", "px", "py").collect()), key=key)
    want = sorted(plain(points, places), key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want] and [r[2] for r in got] == pytest.approx([r[2] for r in want])


def test_few_boxes_are_met(spark):
    """A point meets a handful of leaves, wherever it lies: none is measured against a share of the places that grows."""
    points, places = world(3)
    index = spatial.place_index(spark.createDataFrame([(f"{n}", 1.0 * (n % 200), 1.0 * (n // 200)) for n in range(20_000)], "place string, px double, py double"), "place", "px", "py")
    assert len(index.levels) >= 3 and index.places.groupBy("leaf").count().agg({"count": "max"}).first()[0] <= 32
    far = spark.createDataFrame([(n, 1e5, 5e4 + n) for n in range(50)], "id long, x double, y double")
    assert {r.place for r in spatial.nearest_in(index, far, "id", "x", "y").collect()} == {"19999"}
    one = spatial.nearest(far, spark.createDataFrame([("only", 1.0, 1.0)], "place string, px double, py double"), "id", "x", "y", "place", "px", "py")
    assert {r.place for r in one.collect()} == {"only"} and one.count() == 50
