"""The corpus queries, by name: queries() and oracle_sql() as __spark_entry__ adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymill.llm import byte_bpe, centroids, codes, lines, lm, mixing, oracles, png_media, quality, secrets, simhash, substrings, urls, word_tokens
from waymill.llm.common import bounded_batches, documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return simhash.near_duplicates(documents(spark, sf_dir), distance=3)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return quality.quality_report(documents(spark, sf_dir))


def op4_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return png_media.media_digest(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return word_tokens.token_counts(documents(spark, sf_dir), limit=2048)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(documents(spark, sf_dir), owner_col="source", repository_col="doc_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_report(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_report(documents(spark, sf_dir), length=13)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return byte_bpe.encoding_digest(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return centroids.cluster_report(embeddings(spark, sf_dir))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return lines.line_report(documents(spark, sf_dir), least=20, enough=3)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return codes.code_report(embeddings(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_entropy_mix": op1_entropy_mix,
        "op2_simhash": op2_simhash,
        "op3_quality_rules": op3_quality_rules,
        "op4_png_media": op4_png_media,
        "op5_token_counts": op5_token_counts,
        "op6_secret_scan": op6_secret_scan,
        "op7_url_filter": op7_url_filter,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_lm_score": op9_lm_score,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_line_dedup": op12_line_dedup,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
        "op11_centroid_clusters": oracles.centroid_clusters(),
        "op12_line_dedup": oracles.LINE_DEDUP,
        "op13_vector_codes": oracles.vector_codes(),
    }
