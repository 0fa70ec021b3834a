"""Queries that check tables: expectations and data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators import expect
from waymill.operators.expect import Expected
from waymill.plans.tables import ORDER_INTERVALS, order_intervals, table


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = [
        Expected("o_orderkey", "bigint", nullable=False, unique=True),
        Expected("o_custkey", "bigint", unique=True),
        Expected("o_orderstatus", "string", values=("F", "O")),
        Expected("o_orderpriority", "string", pattern=r"^[1-3]-[A-Z]+$"),
    ]
    return expect.violations(expect.conform(table(spark, sf_dir, "orders"), contract), contract)


CONTRACT_VIOLATIONS = """SELECT 'not_null' AS rule, 'o_orderkey' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS n FROM orders
 UNION ALL SELECT 'values', 'o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
 UNION ALL SELECT 'pattern', 'o_orderpriority', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+$')) FROM orders
 UNION ALL SELECT 'unique', 'o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
 UNION ALL SELECT 'unique', 'o_custkey', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)"""


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_partkey") % 50 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("part"))
    return expect.orphans(lines, "part", table(spark, sf_dir, "part"), "p_partkey")


FK_VIOLATIONS = """SELECT DISTINCT v AS value FROM (SELECT CASE WHEN l_partkey % 50 = 0 THEN -l_partkey ELSE l_partkey END AS v FROM lineitem) WHERE v NOT IN (SELECT p_partkey FROM part)"""


def enum_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.outside_values(table(spark, sf_dir, "part"), "p_type", ["SMALL", "LARGE", "PROMO"])


ENUM_VIOLATIONS = "SELECT p_type AS value, count(*) AS n FROM part WHERE p_type NOT IN ('SMALL', 'LARGE', 'PROMO') GROUP BY 1"


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 40, "-").otherwise(F.col("p_name")).alias("name"), F.when(F.col("p_size") % 5 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("price"), "p_brand")
    return expect.availability(p, ["name", "price", "p_brand"]).withColumn("missing_share", F.round("missing_share", 9))


AVAILABILITY = """SELECT 'name' AS column_name, round(avg(CASE WHEN p_size > 40 THEN 1.0 ELSE 0.0 END), 9) AS missing_share FROM part UNION ALL SELECT 'price', round(avg(CASE WHEN p_size % 5 = 0 THEN 1.0 ELSE 0.0 END), 9) FROM part UNION ALL SELECT 'p_brand', 0.0::DOUBLE"""


def magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = expect.magnitude(table(spark, sf_dir, "lineitem"), {"l_quantity": (5, 45), "l_discount": (0.01, 0.07), "l_extendedprice": (2000, 50000)})
    return out.withColumn("outside_share", F.round("outside_share", 9))


MAGNITUDE = """SELECT 'l_quantity' AS column_name, round(avg(CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 1.0 ELSE 0.0 END), 9) AS outside_share FROM lineitem
 UNION ALL SELECT 'l_discount', round(avg(CASE WHEN l_discount < 0.01 OR l_discount > 0.07 THEN 1.0 ELSE 0.0 END), 9) FROM lineitem UNION ALL SELECT 'l_extendedprice', round(avg(CASE WHEN l_extendedprice < 2000 OR l_extendedprice > 50000 THEN 1.0 ELSE 0.0 END), 9) FROM lineitem"""


def date_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By customer: lines shipped before their order, within 30 days, and after the customer's last order."""
    o = table(spark, sf_dir, "orders")
    ends = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    met = table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(ends, "o_custkey")
    n = lambda cond: F.count(F.when(cond, 1))
    shipped, ordered = F.col("l_shipdate"), F.col("o_orderdate")
    return met.groupBy("o_custkey").agg(n(shipped < ordered).alias("before_order"), n((shipped >= ordered) & (shipped <= ordered + F.expr("INTERVAL 30 DAYS"))).alias("in_time"), n(shipped > F.col("last")).alias("after_last"))


DATE_CONSISTENCY = """WITH e AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1) SELECT o_custkey, count(*) FILTER (l_shipdate < o_orderdate) AS before_order,
 count(*) FILTER (l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAYS) AS in_time, count(*) FILTER (l_shipdate > last) AS after_last FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN e USING (o_custkey) GROUP BY 1"""


def future_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect.future_rows(table(spark, sf_dir, "lineitem"), "l_shipdate", F.lit("2001-01-01").cast("timestamp_ntz"), "l_returnflag")


FUTURE_ROWS = "SELECT l_returnflag, count(*) AS n, max(l_shipdate) AS latest FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-01-01' GROUP BY 1"


def vat_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    exc, rate = F.col("l_extendedprice"), F.col("l_tax")
    vat = F.when(F.col("l_linenumber") == 3, exc * rate + 1).when(F.col("l_linenumber") != 5, exc * rate)
    lines = table(spark, sf_dir, "lineitem").withColumn("ok", expect.vat_consistent(exc * (1 + rate), exc, vat))
    return lines.groupBy("l_linenumber", "ok").agg(F.count("*").alias("n")).withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


VAT_CHECK = """WITH v AS (SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice * (1 + l_tax) AS inc, l_extendedprice AS exc, CASE WHEN l_linenumber = 3 THEN l_extendedprice * l_tax + 1 WHEN l_linenumber <> 5 THEN l_extendedprice * l_tax END AS vat FROM lineitem)
 SELECT l_linenumber, vat IS NULL OR abs(inc - (exc + vat)) <= 1e-8 + 1e-5 * abs(exc + vat) AS ok, count(*) AS n FROM v GROUP BY ALL"""


def interval_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = order_intervals(spark, sf_dir).select("o_custkey", "o_orderkey", "date_from", (F.col("date_to") + F.when(F.col("o_orderkey") % 9 == 0, F.expr("INTERVAL 20 DAYS")).when(F.col("o_orderkey") % 10 == 0, F.expr("INTERVAL -2000 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))).alias("date_to"))
    return expect.interval_faults(iv, ["o_custkey"], "date_from", "date_to", ["o_orderkey"]).select("o_orderkey", "reason")


INTERVAL_FAULTS = f"""WITH {ORDER_INTERVALS}, t AS (SELECT o_custkey, o_orderkey, date_from, date_to + CASE WHEN o_orderkey % 9 = 0 THEN INTERVAL 20 DAYS WHEN o_orderkey % 10 = 0 THEN INTERVAL (-2000) DAYS ELSE INTERVAL 0 DAYS END AS date_to FROM iv),
 r AS (SELECT o_orderkey, CASE WHEN date_to < date_from THEN 'reversed' WHEN date_from < lag(date_to) OVER (PARTITION BY o_custkey ORDER BY date_from, o_orderkey) THEN 'overlap' END AS reason FROM t) SELECT * FROM r WHERE reason IS NOT NULL"""


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("kind", F.when(F.col("p_size") % 3 != 0, F.col("p_type")))
    return p.where(expect.condition("kind", values=[None, "SMALL"]) & expect.condition("p_retailprice", low=1000, high=1500) & expect.condition("p_size", low=10)).select("p_partkey", "kind")


CONDITIONS = "SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_type END AS kind FROM part WHERE (p_size % 3 = 0 OR p_type = 'SMALL') AND p_retailprice BETWEEN 1000 AND 1500 AND p_size >= 10"


def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 30, F.col("p_name")).otherwise("").alias("a"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("b"))
    some = expect.without_missing(p, ["a", "b"], "all").withColumn("kind", F.lit("some"))
    return some.unionByName(expect.without_missing(p, ["a", "b"]).withColumn("kind", F.lit("all"))).groupBy("kind").agg(F.count("*").alias("n"))


COMPLETE_ROWS = "SELECT 'some' AS kind, count(*) AS n FROM part WHERE p_size > 30 OR p_size % 2 = 0 UNION ALL SELECT 'all', count(*) FROM part WHERE p_size > 30 AND p_size % 2 = 0"


def counts_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    told = table(spark, sf_dir, "labels").join(d, "doc_id").groupBy("source").agg(F.count("*").alias("expected"))
    return expect.counts_by_file(d, told, "source")


COUNTS_BY_SOURCE = """WITH t AS (SELECT source, count(*) AS expected FROM labels JOIN documents USING (doc_id) GROUP BY 1), f AS (SELECT source, count(*) AS found FROM documents GROUP BY 1)
 SELECT source, expected, coalesce(found, 0) AS found FROM t FULL JOIN f USING (source) WHERE expected IS DISTINCT FROM coalesce(found, 0)"""


def column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_discount", "l_returnflag"]
    out = expect.availability(lines, cols).join(expect.magnitude(lines, {"l_quantity": (5, 45), "l_discount": (0.01, 0.07)}), "column_name", "full_outer")
    return out.withColumns({c: F.round(c, 9) for c in ("missing_share", "outside_share")})


COLUMN_REPORT = """SELECT 'l_quantity' AS column_name, 0.0::DOUBLE AS missing_share, round(avg(CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 1.0 ELSE 0.0 END), 9) AS outside_share FROM lineitem
 UNION ALL SELECT 'l_discount', 0.0, round(avg(CASE WHEN l_discount < 0.01 OR l_discount > 0.07 THEN 1.0 ELSE 0.0 END), 9) FROM lineitem UNION ALL SELECT 'l_returnflag', 0.0, NULL"""


def single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = expect.with_provenance(table(spark, sf_dir, "supplier"), "acme", "fleet", "supplier")
    return expect.single_source(stamped.withColumn("nation", F.col("s_nationkey")), ["connector_name", "source_table", "nation"])


SINGLE_SOURCE = "SELECT true AS connector_name, true AS source_table, count(DISTINCT s_nationkey) = 1 AS nation FROM supplier"

QUERIES = {
    "q_uniqueness": (contract_violations, CONTRACT_VIOLATIONS),
    "q_fk_violations": (fk_violations, FK_VIOLATIONS),
    "q_enum_violations": (enum_violations, ENUM_VIOLATIONS),
    "q_availability": (availability, AVAILABILITY),
    "q_magnitude": (magnitude, MAGNITUDE),
    "q_date_consistency": (date_consistency, DATE_CONSISTENCY),
    "q_future_rows": (future_rows, FUTURE_ROWS),
    "q_vat_check": (vat_check, VAT_CHECK),
    "q_interval_faults": (interval_faults, INTERVAL_FAULTS),
    "q_conditions": (conditions, CONDITIONS),
    "q_complete_rows": (complete_rows, COMPLETE_ROWS),
    "q_counts_by_source": (counts_by_source, COUNTS_BY_SOURCE),
    "q_column_report": (column_report, COLUMN_REPORT),
    "q_single_source": (single_source, SINGLE_SOURCE),
}
