"""Queries of the curated tables over the given ones: contracts, associations, accidents, taxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.plans import curated
from waymill.plans.tables import ORDER_INTERVALS, order_intervals, table


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract for each customer and day: rents without tax, conflicts unknown."""
    k = F.col("o_orderkey")
    basis = F.when(k % 3 == 0, "ttc").when(k % 3 == 1, "net").otherwise("ht")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("plate_number"), F.col("o_orderdate").alias("date_from"), F.lit(None).cast("timestamp_ntz").alias("date_to"),
        F.when(k % 2 == 0, F.to_date("o_orderdate")).alias("lease_start_date"), F.to_date("o_orderdate").alias("lease_end_date"), (k % 48).alias("lease_months"), (k % 7 * 1000).alias("lease_mileage"),
        basis.alias("rent_basis"), F.when(F.col("o_custkey") % 2 == 0, "personal").otherwise("utility").alias("fiscal_type"), F.round(F.col("o_totalprice") / 1000).alias("base"), F.when(k % 4 != 0, (k % 100).cast("double")).alias("extra"),
    )
    out = curated.contracts(raw, ["base", "extra"])
    return out.select("plate_number", "date_from", "lease_start_date", "lease_end_date", F.col("lease_months").cast("double").alias("lease_months"), "rent_basis", "base", "extra", "total_rent_tax_exc")


CONTRACTS = """WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS plate_number, o_orderdate AS date_from, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS ls, CAST(o_orderdate AS DATE) AS le, o_orderkey % 48 AS m,
   CASE o_orderkey % 3 WHEN 0 THEN 'ttc' WHEN 1 THEN 'net' ELSE 'ht' END AS b, CASE WHEN o_custkey % 2 = 0 THEN 'personal' ELSE 'utility' END AS f, round(o_totalprice / 1000) AS base, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 100 AS DOUBLE) END AS extra FROM orders),
 o AS (SELECT plate_number, date_from, CASE WHEN min(ls) = max(ls) THEN max(ls) END AS ls, CASE WHEN min(le) = max(le) THEN max(le) END AS le, CASE WHEN min(m) = max(m) THEN max(m) END AS m, CASE WHEN min(b) = max(b) THEN max(b) END AS b,
   CASE WHEN min(f) = max(f) THEN max(f) END AS f, CASE WHEN min(base) = max(base) THEN max(base) END AS base, CASE WHEN min(extra) = max(extra) THEN max(extra) END AS extra FROM r GROUP BY 1, 2),
 t AS (SELECT *, coalesce(b = 'ttc' OR (b = 'net' AND f = 'personal'), false) AS taxed FROM o),
 n AS (SELECT plate_number, date_from, coalesce(ls, CAST(date_from AS DATE)) AS lease_start_date, le AS lease_end_date, CAST(m AS DOUBLE) AS lease_months, b AS rent_basis, round(CASE WHEN taxed THEN base / 1.2 ELSE base END, 2) AS base, round(CASE WHEN taxed THEN extra / 1.2 ELSE extra END, 2) AS extra FROM t)
 SELECT *, round(coalesce(base, 0) + coalesce(extra, 0), 2) AS total_rent_tax_exc FROM n"""


def associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct attributions of vehicles to people, matched by name."""
    letters = lambda c: F.translate(c, "0123456789#", "abcdefghij ")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), letters("c_name").alias("full_name"))
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    raw = orders.select((F.col("o_orderkey") % 40).alias("plate_number"), F.upper(letters("c_name")).alias("full_name"), F.trunc("o_orderdate", "month").alias("date_from"), F.last_day("o_orderdate").alias("date_to"))
    return curated.associations(raw, people)[0].select("plate_number", F.col("collaborator_id").cast("double").alias("collaborator_id"), "date_from", "date_to")


ASSOCIATIONS = """SELECT DISTINCT o_orderkey % 40 AS plate_number, CAST(c_custkey AS DOUBLE) AS collaborator_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date_from, last_day(o_orderdate) AS date_to FROM orders JOIN customer ON o_custkey = c_custkey"""


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver at the date of each accident where none is told, and who pays what."""
    drivers = order_intervals(spark, sf_dir).select(F.col("o_custkey").alias("plate_number"), "date_from", "date_to", F.col("o_orderkey").cast("string").alias("driver"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    raw = lines.select(
        F.col("o_custkey").alias("plate_number"), F.col("l_shipdate").alias("accident_date"), F.when(F.col("l_partkey") % 3 == 0, "told").alias("driver"), "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").alias("total_cost"), F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("double").alias("organisation_cost"), F.when(F.col("l_tax") > 0.04, F.col("l_quantity")).alias("self_insured"),
    )
    out = curated.accidents(raw, drivers)
    return out.select("plate_number", "accident_date", "l_orderkey", "l_linenumber", "l_partkey", "driver", F.round("deductible", 2).alias("deductible"), F.round("insurer_cost", 2).alias("insurer_cost"))


ACCIDENTS = f"""WITH {ORDER_INTERVALS}, l AS (SELECT row_number() OVER () AS r, o_custkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS total, floor(l_extendedprice * l_discount) AS own, CASE WHEN l_tax > 0.04 THEN l_quantity END AS self FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 d AS (SELECT r, arg_max(CAST(iv.o_orderkey AS VARCHAR), (date_from, -rank)) AS driver FROM l JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR)) AS rank FROM iv) AS iv ON iv.o_custkey = l.o_custkey AND l_shipdate >= date_from AND (date_to IS NULL OR l_shipdate <= date_to) GROUP BY r)
 SELECT o_custkey AS plate_number, l_shipdate AS accident_date, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN 'told' ELSE driver END AS driver, round(own - coalesce(self, 0), 2) AS deductible, round(total - own, 2) AS insurer_cost FROM l LEFT JOIN d USING (r)"""


def taxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxes with a billing date: as told, or from the quarter, or the year's end; rows without any amount go."""
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 3 == 0, F.to_date("o_orderdate")).alias("start_date"), F.year("o_orderdate").alias("year"), F.when(k % 5 != 0, F.concat(F.lit("Q"), F.quarter("o_orderdate"))).alias("quarter"), F.when(k % 7 != 0, F.col("o_totalprice")).alias("amount"), F.when(k % 2 == 0, 1.0).alias("other"))
    return curated.taxes(raw, ["amount", "other"]).select("id", "billing_date", "amount", "other")


TAXES = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) WHEN o_orderkey % 5 <> 0 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) ELSE make_date(year(o_orderdate), 12, 31) END AS billing_date,
 CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 1.0 END AS other FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 2 = 0"""


QUERIES = {
    "q_contracts": (contracts, CONTRACTS),
    "q_associations": (associations, ASSOCIATIONS),
    "q_accidents": (accidents, ACCIDENTS),
    "q_taxes": (taxes, TAXES),
}
