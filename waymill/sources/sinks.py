"""Writes: delimited exports, and Parquet tables in versions of which only whole ones count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def versions(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """Number and folder of a table's whole versions."""
    fs, root, jvm = _files(spark, table)
    if not fs.exists(root):
        return []
    found = []
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            found.append((int(name[2:]), f"{table}/{name}"))
    return found


def latest_version(spark: SparkSession, table: str, below: int | None = None) -> str | None:
    """The folder of a table's highest whole version, below a number if given; None if there is none."""
    found = [(n, p) for n, p in versions(spark, table) if below is None or n < below]
    return max(found)[1] if found else None


def replace(df: DataFrame, table: str, version: int) -> str:
    """Writes a version; readers see it only once its job has committed."""
    path = f"{table}/v={version:010d}"
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv(df: DataFrame, path: str, mark: str = ";", compression: str = "none") -> None:
    df.write.mode("overwrite").option("sep", mark).option("header", True).option("compression", compression).csv(path)


def by_month(df: DataFrame, path: str, month: str) -> None:
    """Writes or replaces only the months that the rows have."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def cached(spark: SparkSession, path: str, build) -> DataFrame:
    """A table built once and read from then on."""
    found = latest_version(spark, path)
    return spark.read.parquet(found or replace(build(), path, 1))


class Refused(ValueError):
    """A batch that doesn't meet its expectations; ``found`` has the counts."""

    def __init__(self, name: str, found: dict[str, int]) -> None:
        super().__init__(f"batch {name}: {', '.join(f'{n} {k}' for k, n in found.items())}")
        self.found = found


#: A batch of an appended table counts once it has this file.
WHOLE = "_WHOLE"


def append_checked(df: DataFrame, table: str, name: str, faults: dict[str, Column], refuse: bool = True) -> dict[str, int]:
    """Adds the rows as the batch ``name`` (a synchronisation id) of a table, counting rows and faults in the job that writes them.

    faults: conditions that no row should meet, by what they are. With ``refuse``, a batch that has some never counts, and
    ``Refused`` tells how many of which; else they are returned with the number of rows. A batch of the same name is replaced.
    """
    spark = df.sparkSession
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"f{k}") for k, c in enumerate(faults.values())]]
    path = f"{table}/batch={name}"
    roll_back(spark, table, name)
    df.observe(seen, *counts).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    got = seen.get
    found = {what: got[f"f{k}"] for k, what in enumerate(faults) if got[f"f{k}"]}
    if found and refuse:
        roll_back(spark, table, name)
        raise Refused(name, found)
    fs, _, jvm = _files(spark, path)
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{WHOLE}"), True).close()
    return {"rows": got["rows"]} | found


def roll_back(spark: SparkSession, table: str, name: str) -> bool:
    """Takes one batch out of a table: first it counts no more, then its files go. Whether there was one."""
    fs, path, jvm = _files(spark, f"{table}/batch={name}")
    if not fs.exists(path):
        return False
    fs.delete(jvm.org.apache.hadoop.fs.Path(path, WHOLE), False)
    return fs.delete(path, True)


def appended(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows of whole batches, with the batch's name as ``batch``."""
    fs, root, jvm = _files(spark, table)
    whole = [x.getPath() for x in (fs.listStatus(root) if fs.exists(root) else []) if fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), WHOLE))]
    if not whole:
        return spark.createDataFrame([], f"{schema}, batch string")
    read = spark.read.schema(f"{schema}, batch string").option("basePath", table)
    return read.parquet(*[p.toString() for p in whole])
