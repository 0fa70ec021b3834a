"""Nearest places by a packed tree of bounding boxes, in DataFrame operations.

Places are put in the order of a curve that fills the plane, and packed: so many of them to a leaf, sixteen
boxes to a box above. Where places lie close together boxes are small, so clusters, gaps and far outliers cost the same.
Points go down level by level. A box is left out if it begins farther away than some other box is sure to have a
place (each side of a tight box has one). What is left at the leaves, a few of them, is measured; results are exact.
Tables of boxes shrink sixteenfold a level, small ones are sent whole, so the points move only where the boxes are many.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators.common import materialised

#: Places of a leaf and boxes of a box, as powers of two; bits of the curve for each axis; places that are sorted in one
#: task; boxes of a level that is sent whole.
LEAF, FAN, BITS, SORTED, SENT = 5, 4, 24, 200_000, 10_000


class PlaceIndex(NamedTuple):
    """leaf, px, py, place; and from the root down the boxes of each level: node, parent, and their bounds."""

    places: DataFrame
    levels: list[DataFrame]


def finite(a: Column, b: Column) -> Column:
    return a.isNotNull() & b.isNotNull() & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))


def spread_bits(c: str) -> str:
    """SQL of a number of 24 bits with a zero between each two of them."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = f"(({c} | shiftleft({c}, {shift})) & {mask}L)"
    return c


def place_index(places: DataFrame, place: str, px: str, py: str) -> PlaceIndex:
    """Of all places with two finite coordinates; of those at one spot the smallest counts."""
    own = places.select(F.col(place).alias("place"), F.col(px).cast("double").alias("px"), F.col(py).cast("double").alias("py"))
    spots = materialised(own.where(finite(F.col("px"), F.col("py"))).groupBy("px", "py").agg(F.min("place").alias("place")))
    n, x0, x1, y0, y1 = spots.agg(F.count("*"), F.min("px"), F.max("px"), F.min("py"), F.max("py")).first()
    if not n:
        return PlaceIndex(spots.withColumn("leaf", F.lit(0).cast("bigint")), [])
    top = (1 << BITS) - 1
    on_axis = lambda c, low, high: F.floor((F.col(c) / 2 - low / 2) * (top / ((high / 2 - low / 2) or 1.0)))  # noqa: E731  halves, as widths may be beyond doubles
    coded = spots.withColumns({"cx": on_axis("px", x0, x1), "cy": on_axis("py", y0, y1)})
    coded = coded.withColumn("code", F.expr(f"{spread_bits('cx')} | shiftleft({spread_bits('cy')}, 1)")).drop("cx", "cy")
    parts = max(1, math.ceil(n / SORTED))
    dealt = coded.repartitionByRange(parts, "code", "px", "py").sortWithinPartitions("code", "px", "py").withColumn("id", F.monotonically_increasing_id())
    in_part, part, width = F.col("id").bitwiseAND((1 << 33) - 1), F.shiftright("id", 33), max(LEAF, (n - 1).bit_length())
    leaves = materialised(dealt.select(F.shiftright(F.shiftleft(part, width).bitwiseOR(in_part), LEAF).alias("leaf"), "px", "py", "place"))
    boxes = materialised(leaves.groupBy("leaf").agg(F.min("px").alias("xl"), F.max("px").alias("xh"), F.min("py").alias("yl"), F.max("py").alias("yh")))
    bits = width - LEAF + (parts - 1).bit_length()
    levels = []
    for above in range(math.ceil(bits / FAN) - 1, -1, -1):
        node = F.shiftright("leaf", above * FAN)
        level = boxes.groupBy(node.alias("node")).agg(F.min("xl").alias("xl"), F.max("xh").alias("xh"), F.min("yl").alias("yl"), F.max("yh").alias("yh"))
        level = level.withColumn("parent", F.shiftright("node", FAN))
        most = (n >> (LEAF + above * FAN)) + 2 * parts  # boxes of this level
        levels.append(F.broadcast(level) if most <= SENT else materialised(level))
    return PlaceIndex(leaves, levels)


def gap(x: str, low: str, high: str) -> Column:
    return F.greatest(F.col(low) - F.col(x), F.col(x) - F.col(high), F.lit(0.0))


def sure_within(x: str, y: str) -> Column:
    """Square of a distance within which a box has a place: on the nearer of two opposite sides, at its farther end at most."""
    near = lambda c, low, high: F.least(F.abs(F.col(c) - F.col(low)), F.abs(F.col(c) - F.col(high)))
    far = lambda c, low, high: F.greatest(F.abs(F.col(c) - F.col(low)), F.abs(F.col(c) - F.col(high)))
    xs, ys = ("x", "xl", "xh"), ("y", "yl", "yh")
    return F.least(near(*xs) ** 2 + far(*ys) ** 2, far(*xs) ** 2 + near(*ys) ** 2)


def nearest_in(index: PlaceIndex, points: DataFrame, id_col: str, x: str, y: str) -> DataFrame:
    """id, place, distance: the planar nearest place of each row of the points, however far, ties to the smaller place.

    Rows of one id, or without one, have an answer each. Points without two finite coordinates have none.
    """
    own = points.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    left = materialised(own.where(finite(F.col("x"), F.col("y"))).withColumn("row", F.monotonically_increasing_id()))
    at = left.select("row", "x", "y", F.lit(0).cast("bigint").alias("at"))
    each = Window.partitionBy("row")
    for level in index.levels:
        met = at.join(level, F.col("at") == F.col("parent"))
        begins = gap("x", "xl", "xh") ** 2 + gap("y", "yl", "yh") ** 2
        near = met.select("row", "x", "y", "node", begins.alias("begins"), F.min(sure_within("x", "y")).over(each).alias("sure"))
        at = near.where(F.col("begins") <= F.col("sure") * (1 + 1e-9) + 1e-300).select("row", "x", "y", F.col("node").alias("at"))
    far = F.sqrt((F.col("px") - F.col("x")) ** 2 + (F.col("py") - F.col("y")) ** 2)
    best = at.join(index.places, F.col("at") == F.col("leaf")).groupBy("row").agg(F.min(F.struct(far.alias("distance"), F.col("place"))).alias("b"))
    return left.join(best, "row").select("id", "b.place", "b.distance")


def nearest(points: DataFrame, places: DataFrame, id_col: str, x: str, y: str, place: str, px: str, py: str) -> DataFrame:
    """``nearest_in`` an index of the places made for it."""
    return nearest_in(place_index(places, place, px, py), points, id_col, x, y)
