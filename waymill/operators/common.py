"""Keys and orders that several operators share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_key(df: DataFrame) -> Column:
    """A number that tells rows apart while a query runs; it never appears in a result."""
    return F.monotonically_increasing_id()


def ordered_by(columns: list[str], descending: bool = False) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in columns]


def fresh(df: DataFrame | list[str], *names: str) -> list[str]:
    """Names like these that no column of the rows, or none of these names, has."""
    taken = {c.lower() for c in (df if isinstance(df, list) else df.columns)}
    return [next(x for k in range(len(taken) + 1) if (x := f"__{n}{k or ''}").lower() not in taken) for n in names]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is worked out once, not anew for every element of a lambda that reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sent_whole(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A table for a broadcast join if it has few rows by count; otherwise as it is, and Spark chooses."""
    return F.broadcast(df) if df.count() <= most else df


def materialised(df: DataFrame) -> DataFrame:
    """The rows written to the folder that driver and executors share, and read from there on."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: executors need a folder that all of them can read")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="waymill-checkpoint-"))
    return df.checkpoint(eager=True)
