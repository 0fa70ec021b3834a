"""All queries of the library by name, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymill.plans import q_clean, q_curated, q_finance, q_join, q_keys, q_lookup, q_quality, q_time, q_values

MODULES = (q_time, q_join, q_clean, q_quality, q_finance, q_values, q_lookup, q_keys, q_curated)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
