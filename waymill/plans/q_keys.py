"""Queries over keys of many versions, repeated keys, and counts of different values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators import expect, joins, kpi, merge
from waymill.plans.tables import table


def kpi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts of different values and a sum, by year and line status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    of = {"vehicle_id": "l_partkey", "driver_id": "l_suppkey", "collaborator_id": "o_custkey", "user_id": "l_linenumber"}
    facts = lines.select(F.year("l_shipdate").cast("bigint").alias("year"), "l_linestatus", F.col("l_extendedprice").alias("price"), *[F.col(c).alias(n) for n, c in of.items()], F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("traveller_id"))
    formulas = {"vehicles": kpi.leaf("total-vehicles"), "drivers": kpi.leaf("total-drivers"), "collaborators": kpi.leaf("total-collaborators"), "users": kpi.leaf("total-users"), "travellers": kpi.leaf("total-travellers"), "price": kpi.leaf("vehicle-price")}
    return kpi.evaluate(facts, ["year", "l_linestatus"], formulas).withColumn("price", F.round("price", 2))


KPI_COUNTS = """SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_linestatus, CAST(count(DISTINCT l_partkey) AS DOUBLE) AS vehicles, CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS drivers, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS collaborators,
 CAST(count(DISTINCT l_linenumber) AS DOUBLE) AS users, CAST(count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS DOUBLE) AS travellers, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE), 2) AS price
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""


def interval_many_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line with the dearest order of its order's priority in the three days up to its shipping: five keys have all versions."""
    orders = table(spark, sf_dir, "orders")
    versions = orders.select("o_orderpriority", F.col("o_orderdate").alias("date_from"), (F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")).alias("date_to"), F.col("o_orderkey").alias("version"), "o_totalprice")
    own = orders.select("o_orderkey", "o_orderpriority")
    facts = table(spark, sf_dir, "lineitem").join(own, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderpriority", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    out = joins.best_interval(facts, versions, "o_orderpriority", "l_shipdate", "date_from", "date_to", [("o_totalprice", True), ("version", False)], ["version", "o_totalprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.col("version").cast("double").alias("version"), "matched")


INTERVAL_MANY_VERSIONS = """WITH f AS (SELECT row_number() OVER () AS r, o_orderpriority AS k, l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 d AS (SELECT k, day, arg_min(v, (-p, v)) AS version FROM (SELECT o_orderpriority AS k, o_orderkey AS v, o_totalprice AS p, unnest(generate_series(o_orderdate, o_orderdate + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS day FROM orders) GROUP BY 1, 2)
 SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CAST(version AS DOUBLE) AS version, version IS NOT NULL AS matched FROM f LEFT JOIN d ON f.k = d.k AND l_shipdate = day"""


def _agreeing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after their orders: repeated keys are settled by the values in which they agree."""
    target = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("status"), F.lit(None).cast("string").alias("priority"))
    incoming = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return merge.upsert(target, incoming, ["c_custkey"], "overwrite", repeated="agree")


AGREEING = """WITH i AS (SELECT o_custkey AS c_custkey, CASE WHEN min(o_orderstatus) = max(o_orderstatus) THEN max(o_orderstatus) END AS status, CASE WHEN min(o_orderpriority) = max(o_orderpriority) THEN max(o_orderpriority) END AS priority FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1)
 SELECT c_custkey, coalesce(i.status, c_mktsegment) AS status, i.priority FROM customer FULL JOIN i USING (c_custkey)"""


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after their orders, of which each one's latest counts; every customer and every order takes part."""
    target = table(spark, sf_dir, "customer").select("c_custkey", F.lit(None).cast("bigint").alias("order"), F.col("c_acctbal").alias("amount"))
    incoming = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("order"), F.col("o_totalprice").alias("amount"), "o_orderdate")
    out = merge.upsert(target, incoming, ["c_custkey"], "overwrite", modes={"amount": "keep"}, repeated=[F.desc("o_orderdate"), F.desc("order")])
    return out.withColumns({"order": F.col("order").cast("double"), "amount": F.round("amount", 2)})


LATEST = """WITH i AS (SELECT o_custkey AS c_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS p FROM orders GROUP BY 1)
 SELECT c_custkey, CAST(o AS DOUBLE) AS "order", round(CASE WHEN c_name IS NULL THEN p ELSE c_acctbal END, 2) AS amount FROM customer FULL JOIN i USING (c_custkey)"""


def condition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders within bounds, one of two priorities or none known."""
    o = table(spark, sf_dir, "orders").withColumn("kind", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")))
    kept = expect.condition("kind", values=[None, "1-URGENT", "5-LOW"]) & expect.condition("o_totalprice", low=1000, high=200_000) & expect.condition("o_custkey", low=10)
    return o.where(kept).select("o_orderkey", "kind")


CONDITION_ROWS = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS kind FROM orders WHERE (o_orderkey % 3 = 0 OR o_orderpriority IS NULL OR o_orderpriority IN ('1-URGENT', '5-LOW')) AND o_totalprice BETWEEN 1000 AND 200000 AND o_custkey >= 10"


QUERIES = {
    "q_kpi_counts": (kpi_counts, KPI_COUNTS),
    "q_interval_many_versions": (interval_many_versions, INTERVAL_MANY_VERSIONS),
    "q_upsert_repeated_agree": (_agreeing, AGREEING),
    "q_upsert_repeated_latest": (_latest, LATEST),
    "q_condition_rows": (condition_rows, CONDITION_ROWS),
}
