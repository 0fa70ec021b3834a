"""What the corpus operators share: reading, naming and materialising."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; on one machine a new one where it is unset."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: executors need a folder that all of them can read")
        found = tempfile.mkdtemp(prefix="waymill-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def bounded_batches(spark: SparkSession, size: int = 2 << 20) -> None:
    """Bounds the bytes of Arrow batches that carry texts to Python workers, and so what a worker holds besides the
    longest text. A setting of the session, made by the queries; operators don't touch it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and goes on from there, whatever executor is lost later."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: as ``cut_lineage``, but packed; for wide rows that are read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/waymill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(base: str) -> str:
    """A column name that no input column has."""
    return f"__{base}_{uuid.uuid4().hex[:8]}"


def nothing_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
