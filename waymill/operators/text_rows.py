"""Rows from extracted text: fields found line by line, page and document values carried forward."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A value that group 1 of a pattern finds in a line.

    carry: None (only on its own row), "page" or "doc" (holds until the next one there). Of several on one
    page or document with overwrite "preserve" the first holds; with "allow" the latest up to the row.
    """

    name: str
    pattern: str
    carry: str | None = None
    overwrite: str = "allow"


def lines_of(pages: DataFrame, text: str, ids: list[str]) -> DataFrame:
    """ids, line_no, line of every line of a text."""
    return pages.select(*ids, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))


def found(pattern: str, line: Column) -> Column:
    return F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1))


def rows_from_lines(lines: DataFrame, doc: str, page: str, fields: list[Field], row: str) -> DataFrame:
    """One row for each line where the field ``row`` is found, with the carried values known there."""
    own = lines.withColumns({f.name: found(f.pattern, F.col("line")) for f in fields})
    spans = {"page": Window.partitionBy(doc, page).orderBy("line_no"), "doc": Window.partitionBy(doc).orderBy(page, "line_no")}
    for f in fields:
        if f.carry:
            w = spans[f.carry].rowsBetween(Window.unboundedPreceding, 0)
            pick = F.first if f.overwrite == "preserve" else F.last
            own = own.withColumn(f.name, pick(f.name, ignorenulls=True).over(w))
    return own.where(F.col(row).isNotNull()).select(doc, page, "line_no", *[f.name for f in fields])


def repeated_fields(lines: DataFrame, doc: str, page: str, fields: list[Field]) -> DataFrame:
    """field, doc, page, n: values that may not be found twice (overwrite "forbid") and were."""
    banned = [f for f in fields if f.overwrite == "forbid"]
    marks = F.array_compact(F.array(*[F.when(F.col("line").rlike(f.pattern), F.lit(f.name)) for f in banned]))
    return lines.select(doc, page, F.explode(marks).alias("field")).groupBy("field", doc, page).agg(F.count("*").alias("n")).where("n > 1")


def first_fitting(formats: dict[str, DataFrame], doc: str, expected: DataFrame) -> DataFrame:
    """doc, format: the first format, in the order given, whose number of rows is as expected."""
    counts = None
    for rank, (name, rows) in enumerate(formats.items()):
        own = rows.groupBy(doc).agg(F.count("*").alias("found")).select(doc, "found", F.lit(rank).alias("rank"), F.lit(name).alias("format"))
        counts = own if counts is None else counts.unionByName(own)
    return counts.join(expected, doc).where("found = expected").groupBy(doc).agg(F.min_by("format", "rank").alias("format"))
