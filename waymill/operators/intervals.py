"""An index of intervals by key, in DataFrame operations: no row meets more than a few nodes, however many versions a key has.

Time is counted in whole units (days, seconds or microseconds, whichever all values are multiples of). Blocks of 4^l units
form levels; an interval is the union of few blocks, some at each level, none of which lies in a larger one of it. All
rows within a block are covered by each interval that has it, so of these only the best is kept: the index has one
row for each key and block, made by a grouping that Spark begins before it exchanges rows. A row looks up the one block of
each level that it lies in, and takes the best of what it finds.

A key with a third of all rows or of all versions is spread over its blocks; the largest blocks of it, which many rows look up,
have one index row each, so Spark can split or broadcast that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.operators.common import fresh, materialised

#: Microseconds of the units that time is counted in.
UNITS = (86_400_000_000, 1_000_000, 1)


def orderable(df: DataFrame, c: str) -> bool:
    return not dict(df.dtypes)[c].startswith(("map", "variant"))


def sortable(df: DataFrame, order: list[tuple[str, bool]]) -> bool:
    """Whether an order can be had by comparing structs: what descends must have an opposite."""
    kinds = dict(df.dtypes)
    return not any(down and kinds[c].startswith(("string", "binary", "array", "struct")) for c, down in order)


def micros(c: Column) -> Column:
    """Microseconds of a date or time on the wall clock."""
    at = c.cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at)


def sort_key(df: DataFrame, order: list[tuple[str, bool]]) -> list[Column]:
    """Columns whose ascending order is the given one: nulls last where it ascends, first where it descends."""
    kinds, out = dict(df.dtypes), []
    for n, (c, down) in enumerate(order):
        own = F.col(c)
        if kinds[c] == "timestamp":
            own = F.unix_micros(own)
        elif kinds[c].startswith(("date", "timestamp")):
            own = micros(own)
        elif kinds[c] == "boolean":
            own = own.cast("int")
        null = F.col(c).isNotNull() if down else F.col(c).isNull()
        out.append(null.alias(f"n{n}"))
        if down and kinds[c] in ("double", "float"):  # the greatest, but its opposite is itself
            out.append((~F.isnan(own)).alias(f"r{n}"))
        out.append((-own if down else own).alias(f"o{n}"))
    return out


def blocks(low: str, high: str, levels: int) -> Column:
    """(level, block) of the largest blocks that make up [low, high): an array; of columns of whole numbers."""
    floor = lambda x, up: f"shiftright({x}, 2 * (l + {up}))"
    ceil = lambda x, up: floor(f"{x} + shiftleft(1L, 2 * (l + {up})) - 1", up)
    run = lambda a, b: f"CASE WHEN {a} < {b} THEN sequence({a}, {b} - 1) ELSE array() END"
    first, last, above, below = ceil(low, 0), floor(high, 0), ceil(low, 1), floor(high, 1)
    own = f"CASE WHEN {above} < {below} THEN concat({run(first, f'4 * {above}')}, {run(f'4 * {below}', last)}) ELSE {run(first, last)} END"
    return F.expr(f"flatten(transform(sequence(0, {levels - 1}), l -> transform({own}, i -> struct(l AS level, i AS block))))")


def best_at(points: DataFrame, right: DataFrame, k: str, c: str, s: str, e: str, order: list[tuple[str, bool]], values: list[str], closed: bool, best: str, own: str) -> DataFrame:
    """k, c and best, whose field ``own`` has the values of the first interval of the key, by an order, that covers the time c; only where there is one.

    points: columns k and c (``micros``), each pair once. right: columns k, s, e (a null end is open) and the values. The
    right rows are read twice, so they should come from a table.
    """
    low, high, level, block = fresh([*points.columns, *right.columns, best], "low", "high", "level", "block")
    spans = right.where(F.col(s).isNotNull()).select(F.struct(F.struct(*sort_key(right, order)).alias("sort"), F.struct(*values).alias(own)).alias(best), F.col(k), micros(F.col(s)).alias(low), micros(F.col(e)).alias(high))
    of = [F.expr(f"bool_and(coalesce(x % {u} = 0, true))").alias(f"u{n}") for n, u in enumerate(UNITS)]
    bounds = [F.min("x").alias("least"), F.max("x").alias("most")]
    seen = [df.agg(*of, *bounds).first() for df in (points.select(F.col(c).alias("x")), spans.select(F.explode(F.array(low, high)).alias("x")))]
    unit = next(u for n, u in enumerate(UNITS) if all(r[f"u{n}"] is not False for r in seen))
    least = min((r.least for r in seen if r.least is not None), default=0)
    most = max((r.most for r in seen if r.most is not None), default=0)
    place = lambda x: F.expr(f"({x} - {least}L) div {unit}L")
    after = (most - least) // unit + 1
    levels = 1
    while 4**levels <= after:
        levels += 1
    cut = spans.withColumns({low: place(low), high: F.coalesce(place(high) + (1 if closed else 0), F.lit(after))})
    nodes = cut.select(k, best, F.explode(blocks(low, high, levels)).alias("node")).groupBy(k, F.col("node.level").alias(level), F.col("node.block").alias(block)).agg(F.min(best).alias(best))
    nodes = materialised(nodes)
    used = [r[0] for r in nodes.select(level).distinct().collect()]
    asked = points.withColumn(level, F.explode(F.array(*[F.lit(n) for n in sorted(used)]).cast("array<int>")))
    return asked.withColumn(block, F.expr(f"shiftright(({c} - {least}L) div {unit}L, 2 * {level})")).join(nodes, [k, level, block]).groupBy(k, c).agg(F.min(best).alias(best))
