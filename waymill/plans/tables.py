"""Reads of the given tables and the shapes that several queries take them in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c) -> object:
    """A money column as exact decimals, for sums that do not depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,4)")


def dsum(c) -> object:
    return F.sum(cents(c)).cast("double")


def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as intervals, each up to the next one; the last is open."""
    orders = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return orders.select("o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").alias("date_from"), F.lead("o_orderdate").over(w).alias("date_to"))


#: The same in SQL.
ORDER_INTERVALS = """iv AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate AS date_from,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS date_to FROM orders)"""


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's customer: facts to be matched to intervals."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("o_custkey"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


SHIPMENTS = """sh AS (SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
