"""Time-aware joins, checked lookups, hierarchies and nearest neighbours.

Interval joins bring an equality on the key; where a key has few versions the range condition rides along, where it has
many ``intervals`` has an index. Each keeps every left row exactly once. Ties always end with every interval column, so
results are stable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators import intervals
from waymill.operators.alike import similar_names  # noqa: F401
from waymill.operators.common import distinct_key, fresh, materialised, sent_whole

#: Versions of a key up to which its rows meet all of them.
MOST_VERSIONS = 64
#: Answers of the index that are sent whole.
MOST_SENT = 100_000


def covers(at: Column, start: Column, end: Column, closed: bool = True) -> Column:
    """Whether a time lies in an interval; a null end is open."""
    before_end = at <= end if closed else at < end
    return (at >= start) & (end.isNull() | before_end)


def best_interval(left: DataFrame, right: DataFrame, key: str, at: str, start: str, end: str, order: list[tuple[str, bool]], values: list[str], closed: bool = True, fallback: list[tuple[str, bool]] | None = None, mask_fallback: bool = False, most: int = MOST_VERSIONS) -> DataFrame:
    """Left rows with ``values`` of the best interval of their key.

    Of the intervals that cover ``at``, the first by ``order`` counts: pairs of a column (``__start`` and
    ``__end`` for the bounds, or a value) and whether it descends, in which case an open (null) one counts as
    last in time; equal ones are told apart by their bounds and values. With a ``fallback`` order, rows without one take
    their key's first interval by that order, its values kept or, with ``mask_fallback``, set to null. A matched column
    says which it was. Rows whose key has no interval keep nulls.

    A key's intervals travel as one sorted array to its rows while these are ``most`` or fewer; so rows move once, and
    what covers them is found in place. Keys with more have an index (``intervals``) that is asked once for each different
    time of a key; for these, left and right rows are read twice and must come the same. Orders that structs can't have
    (texts that descend) and values without order are ranked by a window.
    """
    k, s, e, row, place, usual, rank, own, best, c = fresh([*left.columns, *values, *right.columns], "key", "start", "end", "row", "rank", "usual", "first", "own", "best", "micros")
    named = {"__start": s, "__end": e}
    order, fallback = ([(named.get(x, x), d) for x, d in o] if o is not None else None for o in (order, None if mask_fallback else fallback))
    r = right.select(F.col(key).alias(k), F.col(start).alias(s), F.col(end).alias(e), *[F.col(v) for v in values])
    tie = [(x, False) for x in (s, e, *values) if x not in dict(order) and intervals.orderable(r, x)]
    if not intervals.sortable(r, [*order, *tie, *(fallback or [])]) or not all(intervals.orderable(r, x) for x in (*values, *dict(order))):
        return _ranked(left, r, key, at, (k, s, e, row, place, usual, rank), [*order, *tie], values, closed, fallback)

    kept = r.where(F.col(k).isNotNull())
    counts = kept.groupBy(k).count()
    many = materialised(counts.where(F.col("count") > most).select(k))
    indexed = not many.isEmpty()
    met, found = left, []
    if indexed:
        many = sent_whole(many)
        points = left.where(F.col(at).isNotNull()).select(F.col(key).alias(k), intervals.micros(F.col(at)).alias(c)).join(many, k, "left_semi").distinct()
        hits = materialised(intervals.best_at(materialised(points), kept.join(many, k, "left_semi"), k, c, s, e, [*order, *tie], values, closed, best, own))
        hits = sent_whole(hits.withColumnRenamed(k, row), MOST_SENT)
        met = met.join(hits, (left[key] == hits[row]) & (intervals.micros(left[at]) == hits[c]), "left").drop(row, c)
        found.append(F.col(best)[own])
    if not indexed or not counts.where(F.col("count") <= most).isEmpty():
        few = kept.join(many, k, "left_anti") if indexed else kept
        ordered = F.array_sort(F.collect_list(F.struct(F.struct(*intervals.sort_key(r, [*order, *tie])).alias("sort"), s, e, F.struct(*values).alias(own))))
        held = F.transform(ordered, lambda v: F.struct(v[s].alias(s), v[e].alias(e), v[own].alias(own)))
        lists = few.groupBy(k).agg(held.alias(place), *_first(r, fallback, values, own, usual))
        met = met.join(lists, met[key] == lists[k], "left").drop(k)
        found.append(F.get(F.filter(place, lambda v: covers(F.col(at), v[s], v[e], closed)), F.lit(0))[own])
    if fallback is not None and indexed:
        firsts = kept.join(many, k, "left_semi").groupBy(k).agg(*_first(r, fallback, values, own, rank))
        met = met.join(firsts, met[key] == firsts[k], "left").drop(k)
    met = met.select(*[F.col(x) for x in left.columns], F.coalesce(*found).alias(best), *[F.col(x) for x in (usual, rank) if x in met.columns])
    firsts = [F.col(x)[own] for x in (usual, rank) if x in met.columns]
    shown = lambda v: F.when(F.col(best).isNotNull(), F.col(best)[v]).otherwise(F.coalesce(*[x[v] for x in firsts]) if firsts else F.lit(None))
    return met.select(*[F.col(x) for x in left.columns], *[shown(v).alias(v) for v in values], F.col(best).isNotNull().alias("matched"))


def _first(r: DataFrame, fallback: list[tuple[str, bool]] | None, values: list[str], own: str, name: str) -> list[Column]:
    """A key's first interval by the fallback order, if there is one; of equals the least values."""
    return [] if fallback is None else [F.min(F.struct(F.struct(*intervals.sort_key(r, fallback)).alias("sort"), F.struct(*values).alias(own))).alias(name)]


def _ranked(left: DataFrame, r: DataFrame, key: str, at: str, names: tuple[str, ...], order: list[tuple[str, bool]], values: list[str], closed: bool, fallback: list[tuple[str, bool]] | None) -> DataFrame:
    """``best_interval`` by a join and a window."""
    k, s, e, row, place, usual, rank = names
    sort = lambda c, down: c.desc_nulls_first() if down else c.asc_nulls_last()
    own = left.withColumn(row, distinct_key(left))
    met = own.join(r, (own[key] == r[k]) & covers(F.col(at), F.col(s), F.col(e), closed), "left")
    first = F.row_number().over(Window.partitionBy(row).orderBy(*[sort(F.col(c), d) for c, d in order]))
    out = met.withColumn(place, first).where(F.col(place) == 1).withColumn("matched", F.col(k).isNotNull()).drop(place, row, k, s, e)
    if fallback is None:
        return out
    by = F.row_number().over(Window.partitionBy(k).orderBy(*[sort(F.col(c), d) for c, d in fallback]))
    held = {v: f"{usual}_{n}" for n, v in enumerate(values)}
    first = r.withColumn(rank, by).where(F.col(rank) == 1).select(F.col(k).alias(usual), *[F.col(v).alias(h) for v, h in held.items()])
    other = out.join(first, out[key] == first[usual], "left")
    return other.withColumns({v: F.when(F.col("matched"), F.col(v)).otherwise(F.col(h)) for v, h in held.items()}).drop(usual, *held.values())


def enrich(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Fills only what is null in the left rows, from a right side that has each key once; a repeated one fails while the join runs."""
    held = dict(zip(values, fresh([*left.columns, *keys], *[f"v{n}" for n in range(len(values))])))
    r = right.dropna(subset=keys).select(*keys, *[F.col(v).alias(h) for v, h in held.items()])
    met = checked_join(left, r, keys)
    return met.withColumns({v: F.coalesce(F.col(v), F.col(h)) if v in left.columns else F.col(h) for v, h in held.items()}).drop(*held.values())


def unique_only(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once; ambiguous and null keys go altogether."""
    (n,) = fresh(df, "n")
    counted = df.dropna(subset=keys).withColumn(n, F.count("*").over(Window.partitionBy(*keys)))
    return counted.where(F.col(n) == 1).drop(n)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def checked_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join whose right side must have each key once: a repeated one fails while the join runs."""
    (n,) = fresh(right, "n")
    once = right.withColumn(n, F.count("*").over(Window.partitionBy(*keys)))
    told = F.raise_error(F.concat(F.lit("key is not unique: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys])))
    return left.join(once.where(F.when(F.col(n) == 1, True).otherwise(told.cast("boolean"))).drop(n), keys, how)


def not_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows whose key the right side lacks; null keys equal each other."""
    on = [left[k].eqNullSafe(right[k]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(right, cond, "left_anti")


def paths(nodes: DataFrame, id_col: str, name_col: str, parent_col: str, mark: str = " > ") -> DataFrame:
    """id, path (names from the root), depth of every node that a root reaches, however deep.

    By pointer doubling: each node has a path up to some ancestor, and takes that one's path in front of its own, so
    paths double in length and the rounds are as many as the logarithm of the depth. A node without a parent is done; once a
    round brings none to its end, no deeper one exists. Nodes of a circle that no root reaches have no path, nor have those
    whose parent is missing; a circle that a root reaches, by an id with two parents, is an error.
    """
    now = materialised(nodes.select(F.col(id_col).alias("id"), F.col(name_col).cast("string").alias("path"), F.col(parent_col).alias("up"), F.lit(1).alias("depth")))
    told = lambda df: df.agg(F.count("*"), F.count_if(F.col("up").isNull()), F.max(F.when(F.col("up").isNull(), F.col("depth")))).first()
    most, done, _ = told(now)
    while done:
        above = now.select(F.col("id").alias("up"), F.col("path").alias("before"), F.col("up").alias("next"), F.col("depth").alias("more"))
        grown = now.join(above, "up").select("id", F.concat_ws(mark, "before", "path").alias("path"), F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        now = materialised(now.where("up IS NULL").unionByName(grown))
        _, ended, deepest = told(now)
        if deepest > most:
            raise ValueError("nodes go round in a circle")
        if ended == done:
            break
        done = ended
    return now.where("up IS NULL").select("id", "path", "depth")


def routed(items: DataFrame, rules: DataFrame, name: str, pattern: str, target: str, text: str, most_rules: int = 10_000) -> DataFrame:
    """Items with each rule whose pattern is found in their text; n_rules tells how many fit, so that 0 or more than 1 can be told.

    Patterns are tried on each different text once, so repeated items don't count twice. Rules are configuration:
    all of them go to every task, more than ``most_rules`` are an error.
    """
    own = rules.select(F.col(name).alias("rule"), F.col(pattern).alias("pattern"), F.col(target).alias("target"))
    if own.count() > most_rules:
        raise ValueError(f"more than {most_rules} rules")
    text_key, n_rules = fresh(items, "text", "n")
    met = items.select(F.col(text).alias(text_key)).distinct().join(F.broadcast(own), F.expr(f"regexp_like({text_key}, pattern)"))
    hits = met.withColumn(n_rules, F.count("rule").over(Window.partitionBy(text_key))).drop("pattern")
    joined = items.join(hits, items[text] == hits[text_key], "left")
    return joined.select(*[items[c] for c in items.columns], "rule", "target", F.coalesce(n_rules, F.lit(0)).alias("n_rules"))


def valid_at(params: DataFrame, at: Column, start: str = "date_from", end: str = "date_to") -> DataFrame:
    """Parameters valid at a time; null bounds are open."""
    return params.where((F.col(start).isNull() | (F.col(start) <= at)) & (F.col(end).isNull() | (F.col(end) >= at)))

