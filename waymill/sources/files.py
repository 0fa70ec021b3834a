"""Scans of files as they come: delimited, fixed width, compressed, JSON arrays, sheets, and listings."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.operators.expect import Expected, conform, with_provenance
from waymill.operators.joins import routed


def delimited(spark: SparkSession, paths: str | list[str], columns: list[str] | dict[str, str], mark: str = ";", encoding: str = "ISO-8859-1", skip_broken: bool = False) -> DataFrame:
    """All columns as text under the names given: those of the header, or from the header's to others.

    A file whose header has other names, or the same in another order, fails while it is read; a line that does not
    fit keeps its text in ``corrupt``, a broken file may be skipped.
    """
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    schema = ", ".join(f"`{c}` string" for c in [*names, "corrupt"])
    read = spark.read.schema(schema).option("sep", mark).option("encoding", encoding).option("header", True).option("enforceSchema", False)
    rows = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").option("ignoreCorruptFiles", str(skip_broken).lower()).csv(paths)
    return rows.withColumnsRenamed({a: b for a, b in names.items() if a != b})


def _headers(spark: SparkSession, path: str, mark: str, encoding: str) -> dict[tuple[str, ...], list[str]]:
    """The files that a path or pattern names, by their first line; one line of each is read, wherever Spark can read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    store, out = where.getFileSystem(conf), {}
    found = [x for top in store.globStatus(where) or [] for x in (store.listStatus(top.getPath()) if top.isDirectory() else [top])]
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    for x in found:
        if x.isDirectory() or x.getPath().getName()[0] in "._":
            continue
        stream, codec = store.open(x.getPath()), codecs.getCodec(x.getPath())
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
        line = lines.readLine()
        lines.close()
        if line is not None:
            header = tuple(c.strip() for c in next(csv.reader([line.removeprefix("\ufeff")], delimiter=mark)))
            out.setdefault(header, []).append(x.getPath().toString())
    return out


def delimited_by_name(spark: SparkSession, path: str, columns: list[str] | dict[str, str], mark: str = ";", encoding: str = "ISO-8859-1", skip: list[str] = (), skip_broken: bool = False) -> DataFrame:
    """All columns as text under the names given, found by name in headers of any order, file by file; with ``file`` and ``corrupt``.

    A missing or repeated column fails. Columns that nobody named may be there if listed in ``skip``, or if they have no
    values (nothing, or 0); another value fails while it is read. Files of one header are one scan.
    """
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    parts = []
    for header, paths in sorted(_headers(spark, path, mark, encoding).items()):
        for n in names:
            if header.count(n) != 1:
                raise ValueError(f"{paths[0]}: the header has column {n} {header.count(n)} times")
        at = [f"c{k}" for k in range(len(header))]
        read = spark.read.schema(", ".join(f"{c} string" for c in [*at, "corrupt"])).option("sep", mark).option("encoding", encoding).option("header", True).option("enforceSchema", True)
        rows = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").option("ignoreCorruptFiles", str(skip_broken).lower()).csv(paths)
        empty = F.lit(True)
        for k, n in enumerate(header):
            if n not in names and n not in skip:
                told = F.raise_error(F.concat(F.lit(f"column {n} of the header is not expected and has the value "), F.col(at[k]))).cast("boolean")
                empty = empty & F.when(F.coalesce(F.trim(at[k]), F.lit("")).isin("", "0"), True).otherwise(told)
        parts.append(rows.where(empty).select(*[F.col(at[header.index(n)]).alias(new) for n, new in names.items()], F.col("_metadata.file_path").alias("file"), "corrupt"))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*names.values(), "file", "corrupt"]))
    return reduce(DataFrame.unionByName, parts)


def table(df: DataFrame, contract: list[Expected], connector: str, dataset: str, name: str) -> DataFrame:
    """A scan brought under its contract and stamped with its source."""
    return with_provenance(conform(df, contract), connector, dataset, name)


def sheets(spark: SparkSession, folder: str, columns: list[str], mark: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Sheets exported as one file each, under one another, with their file's name as sheet_name."""
    return delimited(spark, folder, columns, mark, encoding).withColumn("sheet_name", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1))


def zipped(spark: SparkSession, paths: str, columns: list[str], mark: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """The first member of each zip file as text columns, quotes read as in other delimited files; another header is an error.

    The mark is one character. An archive is one row while it is unpacked, so it may have 2 GB at most; its member
    is read piece by piece.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as member:
                    lines = csv.reader(io.TextIOWrapper(member, encoding=encoding, newline=""), delimiter=mark)
                    header = next(lines, columns)
                    if header[: len(columns)] != columns:
                        raise ValueError(f"{path}: header {header} is not {columns}")
                    while part := list(islice(lines, 10_000)):
                        cut = [[*x, *[None] * (len(columns) - len(x))][: len(columns)] for x in part if x]
                        yield pd.DataFrame([[path, *x] for x in cut], columns=["path", *columns], dtype=object)

    schema = ", ".join(f"`{c}` string" for c in ["path", *columns])
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(rows, schema)


def fixed_width(lines: DataFrame, fields: dict[str, tuple[int, int]], value: str = "value") -> DataFrame:
    """Trimmed slices [start, end) of each line."""
    for name, (start, end) in fields.items():
        if start < 0 or end <= start:
            raise ValueError(f"field {name}: {start} to {end}")
    return lines.select("*", *[F.trim(F.substring(value, start + 1, end - start)).alias(name) for name, (start, end) in fields.items()]).drop(value)


def matching_lines(lines: DataFrame, pattern: str, value: str = "value") -> DataFrame:
    """Lines that match at their start."""
    return lines.where(F.col(value).rlike(f"^(?:{pattern})"))


def blocks(lines: DataFrame, begins: Column, file: str, order: str) -> DataFrame:
    """Adds the number of the block a line is in: how many lines up to it begin one, by file."""
    w = Window.partitionBy(file).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("block", F.sum(F.coalesce(begins, F.lit(False)).cast("int")).over(w))


def json_array(spark: SparkSession, paths: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(paths)


def json_pages(pages: DataFrame, value: str, keys: list[str], schema: str) -> DataFrame:
    """Rows of landed response pages: the list, or the one object, at a path of keys."""
    at = F.get_json_object(value, "$" + "".join(f".{k}" for k in keys))
    many = F.when(F.startswith(F.trim(at), F.lit("[")), at).otherwise(F.concat(F.lit("["), at, F.lit("]")))
    return pages.select(F.explode(F.from_json(many, f"array<struct<{schema}>>")).alias("r")).select("r.*")


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, name, modified, length of files whose name matches at its start; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    named = files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("modificationTime").alias("modified"), "length")
    return named.where(F.col("name").rlike(f"^(?:{pattern})"))


def newest(files: DataFrame) -> DataFrame:
    """The newest file; of equal times all are returned, so that a tie can be told."""
    return files.join(F.broadcast(files.agg(F.max("modified").alias("modified"))), "modified", "left_semi").select(files.columns)


def document_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """path, sha256, size of every file."""
    return spark.read.format("binaryFile").load(folder).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def routed_files(files: DataFrame, routes: DataFrame) -> DataFrame:
    """Files with the routes whose pattern their path fits; n_routes tells those with none or several."""
    met = routed(files, routes.withColumn("route", F.struct("pattern", "organisation", "connector")), "pattern", "pattern", "route", "path")
    return met.select(*[F.col(c) for c in files.columns], F.col("target.pattern").alias("pattern"), F.col("target.organisation").alias("organisation"), F.col("target.connector").alias("connector"), F.col("n_rules").alias("n_routes"))


def widened(df: DataFrame, low: str, high: str, days: int, at: str) -> DataFrame:
    """Stored rows within a batch's dates, some days wider; constant bounds reach the scan as pushed filters."""
    return df.where(F.col(at).between(F.date_sub(F.lit(low).cast("date"), days), F.date_add(F.lit(high).cast("date"), days)))
