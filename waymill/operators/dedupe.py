"""Deduplication by policy, each as one grouping or one window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators.common import fresh


def agreed(c: str) -> Column:
    """The group's only distinct value that is not null; null where several disagree."""
    return F.when(F.min(c) == F.max(c), F.max(c))


def conflict_to_null(df: DataFrame, keys: list[str], columns: list[str], any_of: list[str] = ()) -> DataFrame:
    """One row per key: each column's value where all rows agree, else null; ``any_of`` columns take the least value. Null keys form a group."""
    return df.groupBy(*keys).agg(*[agreed(c).alias(c) for c in columns], *[F.min(c).alias(c) for c in any_of])


def conflicts(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """For each column, how many keys have several values."""
    per_key = df.groupBy(*keys).agg(*[(F.min(c) != F.max(c)).alias(c) for c in columns])
    counts = per_key.agg(*[F.count(F.when(F.col(c), 1)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_conflicts")


def latest_per_column(df: DataFrame, keys: list[str], at: str, policies: dict[str, str]) -> DataFrame:
    """One row per key; each column is taken from the rows of its latest date that have a value.

    Policies where those rows differ: "null" (unknown), "max", "min", "any" (the least). Null dates are oldest.
    """
    when = F.coalesce(F.col(at).cast("timestamp_ntz"), F.lit("1900-01-01").cast("timestamp_ntz"))
    own, *held = fresh(df, "at", *[f"top{n}" for n in range(len(policies))])
    tops = [F.max(F.when(F.col(c).isNotNull(), when)).over(Window.partitionBy(*keys)).alias(h) for c, h in zip(policies, held)]
    top = df.select("*", when.alias(own), *tops)
    value = {c: F.when(F.col(own) == F.col(h), F.col(c)) for c, h in zip(policies, held)}
    picks = {"null": lambda v: F.when(F.min(v) == F.max(v), F.max(v)), "max": F.max, "min": F.min, "any": F.min}
    return top.groupBy(*keys).agg(*[picks[how](value[c]).alias(c) for c, how in policies.items()])


def keep_extreme(df: DataFrame, keys: list[str], by: str, extreme: str = "max") -> DataFrame:
    """Rows that have their group's extreme value, all of equals, and rows without a value."""
    best = getattr(F, extreme)(by).over(Window.partitionBy(*keys))
    (name,) = fresh(df, "best")
    return df.withColumn(name, best).where(F.col(by).isNull() | (F.col(by) == F.col(name))).drop(name)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by an order that ends with a unique column."""
    (rank,) = fresh(df, "rank")
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) == 1).drop(rank)


def first_values(df: DataFrame, keys: list[str], order: list[str], columns: list[str], collect: dict[str, str] | None = None) -> DataFrame:
    """One row per key: each column's first value that is not null, by order; ``collect`` lists distinct values of a column, sorted and comma-joined."""
    at = F.struct(*order)
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
    lists = [F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(name) for name, c in (collect or {}).items()]
    return df.dropna(subset=keys).groupBy(*keys).agg(*firsts, *lists)


def filled_in_group(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Missing values from the row before, else the row after, within the key; then distinct rows of keys and columns."""
    w = Window.partitionBy(*keys).orderBy(*order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    fill = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(ahead))
    return df.select(*keys, *[fill(c).alias(c) for c in columns]).distinct()


def current_version(df: DataFrame, keys: list[str], start: str, end: str, now: Column, tie: list[str], name: str = "version_rank", ties_equal: bool = False) -> DataFrame:
    """Adds the rank of each version: latest start first, then latest end (open ones end now), then ``tie``."""
    order = [F.col(start).desc_nulls_last(), F.coalesce(F.col(end), now).desc(), *([] if ties_equal else [F.col(c).asc() for c in tie])]
    rank = F.rank() if ties_equal else F.row_number()
    return df.withColumn(name, rank.over(Window.partitionBy(*keys).orderBy(*order)))
