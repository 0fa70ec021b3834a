"""Reshaping and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.operators.common import fresh, materialised, sent_whole


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts by column name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def long(df: DataFrame, ids: list[str], values: list[str] | None, name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)


def pivoted(df: DataFrame, keys: list[str], name: str, values: list[str], agg: Column) -> DataFrame:
    """One column for each listed value, without a look at the data for them."""
    return df.groupBy(*keys).pivot(name, values).agg(agg)


def exploded(df: DataFrame, column: str, mark: str = ",") -> DataFrame:
    """A row for each trimmed part of a list in a text; empty parts go."""
    return df.withColumn(column, F.explode(F.split(column, mark))).withColumn(column, F.trim(column)).where(F.col(column) != "")


def path_of(levels: list[Column], mark: str = " > ") -> Column:
    """Level names joined, nulls and empty ones left out; null if none is left."""
    return F.nullif(F.concat_ws(mark, *[F.nullif(F.trim(c), F.lit("")) for c in levels]), F.lit(""))


def last_level(path: Column, mark: str = " > ") -> Column:
    return F.element_at(F.split(path, mark), -1)


def placed(df: DataFrame, keys: list[str], order: list[tuple[str, bool]], name: str) -> DataFrame:
    """Adds each row's place, from 1, in its group sorted by several columns, each up or (True) down; nulls come last.

    A group's rows are split by ranges of the order, sorted there, and count on from the ranges before, so no
    group is sorted in one task. Rows that are equal in all columns of the order get their places in any order.
    """
    sort = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    part, before, own = fresh(df, "part", "before", "own")
    ranges = materialised(df.repartitionByRange(*[F.col(k) for k in keys], *sort).withColumn(part, F.spark_partition_id()))
    sizes = ranges.groupBy(*keys, part).agg(F.count("*").cast("long").alias(own))
    starts = sizes.withColumn(before, F.sum(own).over(Window.partitionBy(*keys).orderBy(part)) - F.col(own)).select(*[F.col(k).alias(f"{k} of starts") for k in keys], F.col(part).alias(f"{part}s"), before)
    ranked = ranges.withColumn(own, F.row_number().over(Window.partitionBy(*keys, part).orderBy(*sort)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"`{k} of starts`")) for k in keys], F.col(part) == F.col(f"{part}s"))
    met = ranked.join(sent_whole(starts), same).withColumn(name, F.col(before) + F.col(own))
    return met.select(*df.columns, name)


def row_total(columns: list[str]) -> Column:
    """Sum over a row's columns, null as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def chosen(catalogue: dict[str, DataFrame], include: list[str], exclude: list[str] = (), any_of: list[set[str]] = (), all_of: list[set[str]] = ()) -> DataFrame:
    """Union of the tables whose names fit ``include`` and not ``exclude`` (``*`` fits anything).

    A table must have a column of every set in ``any_of``; a set in ``all_of`` is taken only where it is
    whole. The source's name is added. With no table left it fails.
    """
    from fnmatch import fnmatchcase

    parts = []
    for name, df in sorted(catalogue.items()):
        if not any(fnmatchcase(name, p) for p in include) or any(fnmatchcase(name, p) for p in exclude):
            continue
        have = set(df.columns)
        if any(not have & group for group in any_of):
            continue
        drop = {c for group in all_of if not group <= have for c in group}
        parts.append(df.select(*[c for c in df.columns if c not in drop]).withColumn("source_table", F.lit(name)))
    if not parts:
        raise LookupError("no table fits")
    return union_all(parts)
