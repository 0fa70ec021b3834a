"""A corpus pipeline: quality rules, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last
return the columns of documents. Null texts and short ones go in the first stage; null ids, repeated rows,
ties and empty tables are as the operators' own docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.llm import byte_bpe, mixing, quality, secrets, shingles
from waymill.llm.common import bounded_batches, cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the distances to their language keep."""
    bounded_batches(spark)
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group linked by a similarity of five-word shingles of 0.8 or more."""
    bounded_batches(spark)
    return shingles.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and lengths brought up to date."""
    return secrets.redact(docs, owner_col="source", repository_col="doc_id").withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and the decoded bytes of each row."""
    bounded_batches(spark)
    return byte_bpe.encoding_digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("tokens", tokens),
]

#: Distances, trees, dual solutions and merges have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what one keeps is written to the shared folder before the next, so no stage runs twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
