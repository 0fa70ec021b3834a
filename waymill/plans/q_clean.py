"""Queries that deduplicate rows and bring tables up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators import dedupe, merge, reshape
from waymill.plans.tables import dsum, order_intervals, table


def conflict_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedupe.conflict_to_null(lines, ["l_orderkey"], ["l_returnflag", "l_linestatus"], any_of=["l_partkey"])


CONFLICT_DEDUPE = """SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN max(l_returnflag) END AS l_returnflag, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN max(l_linestatus) END AS l_linestatus,
 min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey"""


def conflict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.conflicts(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])


CONFLICT_COUNTS = """WITH c AS (SELECT count(DISTINCT l_returnflag) AS a, count(DISTINCT l_linestatus) AS b FROM lineitem GROUP BY l_orderkey)
 SELECT 'l_returnflag' AS column_name, count(*) FILTER (a > 1) AS n_conflicts FROM c UNION ALL SELECT 'l_linestatus', count(*) FILTER (b > 1) FROM c"""


def latest_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("dearest"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"))
    return dedupe.latest_per_column(orders, ["o_custkey"], "o_orderdate", {"status": "null", "dearest": "max", "priority": "min"})


LATEST_PER_COLUMN = """WITH o AS (SELECT o_custkey, o_orderdate, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS dearest, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority FROM orders),
 k AS (SELECT DISTINCT o_custkey FROM o),
 a AS (SELECT o_custkey, CASE WHEN count(DISTINCT status) = 1 THEN max(status) END AS status FROM o WHERE status IS NOT NULL AND (o_custkey, o_orderdate) IN (SELECT (o_custkey, max(o_orderdate)) FROM o WHERE status IS NOT NULL GROUP BY o_custkey) GROUP BY 1),
 b AS (SELECT o_custkey, max(dearest) AS dearest FROM o WHERE dearest IS NOT NULL AND (o_custkey, o_orderdate) IN (SELECT (o_custkey, max(o_orderdate)) FROM o WHERE dearest IS NOT NULL GROUP BY o_custkey) GROUP BY 1),
 c AS (SELECT o_custkey, min(priority) AS priority FROM o WHERE priority IS NOT NULL AND (o_custkey, o_orderdate) IN (SELECT (o_custkey, max(o_orderdate)) FROM o WHERE priority IS NOT NULL GROUP BY o_custkey) GROUP BY 1)
 SELECT o_custkey, status, dearest, priority FROM k LEFT JOIN a USING (o_custkey) LEFT JOIN b USING (o_custkey) LEFT JOIN c USING (o_custkey)"""


def keep_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("seen_at"))
    return dedupe.keep_extreme(orders, ["o_custkey"], "seen_at")


KEEP_EXTREME = """WITH o AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS seen_at FROM orders)
 SELECT * FROM o WHERE seen_at IS NULL OR seen_at = (SELECT max(seen_at) FROM o x WHERE x.o_custkey = o.o_custkey)"""


def first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("status", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")))
    return dedupe.first_values(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["status", "o_totalprice"], {"priorities": "o_orderpriority"})


FIRST_NON_NULL = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status FROM orders)
 SELECT o_custkey, first(status ORDER BY o_orderdate, o_orderkey) FILTER (status IS NOT NULL) AS status, first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS o_totalprice, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM o GROUP BY o_custkey"""


def filled_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"))
    return dedupe.filled_in_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["status"])


FILLED_GROUP = """WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status FROM orders)
 SELECT DISTINCT o_custkey, coalesce(last_value(status IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING),
 first_value(status IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS status FROM o"""


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where("c_custkey % 4 <> 3").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("balance"))


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where("c_custkey % 5 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.lower("c_mktsegment")).alias("segment"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal") + 1000).alias("balance"))


STATES = """t AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance, true AS has FROM customer WHERE c_custkey % 4 <> 3),
 i AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN lower(c_mktsegment) END AS segment, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal + 1000 END AS balance, true AS has FROM customer WHERE c_custkey % 5 <> 0)"""


def _upsert(mode: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = merge.upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), ["c_custkey"], mode)
        return out.withColumn("balance", F.round("balance", 2))

    values = {"keep": "t.{0}", "null_only": "coalesce(t.{0}, i.{0})", "overwrite": "coalesce(i.{0}, t.{0})", "inc_null": "i.{0}"}[mode]
    of = lambda c: f"CASE WHEN t.has IS NULL THEN i.{c} WHEN i.has IS NULL THEN t.{c} ELSE {values.format(c)} END"
    return run, f"WITH {STATES} SELECT c_custkey, {of('segment')} AS segment, round({of('balance')}, 2) AS balance FROM t FULL JOIN i USING (c_custkey)"


def protected_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), ["c_custkey"], "overwrite", modes={"segment": "null_only"}).withColumn("balance", F.round("balance", 2))


PROTECTED_UPSERT = f"""WITH {STATES} SELECT c_custkey, CASE WHEN t.has IS NULL THEN i.segment WHEN i.has IS NULL THEN t.segment ELSE coalesce(t.segment, i.segment) END AS segment,
 round(CASE WHEN t.has IS NULL THEN i.balance WHEN i.has IS NULL THEN t.balance ELSE coalesce(i.balance, t.balance) END, 2) AS balance FROM t FULL JOIN i USING (c_custkey)"""


def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = order_intervals(spark, sf_dir).select("o_custkey", "date_from", "date_to", F.col("o_totalprice").alias("rent"), F.when(F.col("o_orderkey") % 2 == 0, "note").alias("note"))
    new = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("o_custkey"), F.lit("2001-06-01").cast("timestamp_ntz").alias("date_from"), F.lit(None).cast("timestamp_ntz").alias("date_to"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("rent"), F.lit("new").alias("note"))
    return merge.new_versions(stored, new, ["o_custkey"], "date_from", "date_to", {"rent": "number"}, tolerance={"rent": 1.0})


SCD2 = """WITH iv AS (SELECT o_custkey, o_orderdate AS date_from, lead(o_orderdate) OVER w AS date_to, o_totalprice AS rent, CASE WHEN o_orderkey % 2 = 0 THEN 'note' END AS note,
   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
 n AS (SELECT c_custkey AS o_custkey, TIMESTAMP '2001-06-01' AS s, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS r FROM customer WHERE c_custkey % 3 <> 0),
 b AS (SELECT iv.*, n.s, n.r, coalesce(n.s IS NOT NULL AND n.r IS NOT NULL AND (rent IS NULL OR abs(rent - n.r) > 1) AND n.s > iv.date_from, false) AS turned FROM iv LEFT JOIN n USING (o_custkey) WHERE k = 1)
 SELECT o_custkey, date_from, date_to, rent, note FROM iv WHERE k > 1
 UNION ALL SELECT o_custkey, date_from, CASE WHEN turned THEN s ELSE date_to END, CASE WHEN turned OR s IS NULL THEN rent ELSE coalesce(rent, r) END, CASE WHEN turned OR s IS NULL THEN note ELSE coalesce(note, 'new') END FROM b
 UNION ALL SELECT o_custkey, s, NULL, r, 'new' FROM b WHERE turned
 UNION ALL SELECT o_custkey, s, NULL, r, 'new' FROM n WHERE o_custkey NOT IN (SELECT o_custkey FROM iv)"""


def replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    stored = o.where("o_orderkey % 2 = 0").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("confirmed"))
    computed = o.where("o_orderkey % 2 = 1").select("o_custkey", "o_orderkey", F.lit(None).cast("timestamp_ntz").alias("confirmed"))
    return merge.replace_computed(stored, computed, ["o_custkey"], "confirmed")


REPLACED = """WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate AS confirmed FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus = 'F')
 SELECT * FROM s UNION ALL SELECT o_custkey, o_orderkey, NULL FROM orders WHERE o_orderkey % 2 = 1 AND o_custkey NOT IN (SELECT o_custkey FROM s)"""


def replaced_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return merge.replace_for(e, e.where("event_type = 'view'").withColumn("user_id", F.col("user_id") + 1000), "event_type", ["view"])


REPLACED_SOURCE = "SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN user_id + 1000 ELSE user_id END AS user_id FROM events"


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    want = c.where("c_custkey % 5 <> 0").select("c_custkey", F.col("c_nationkey").alias("vehicle_group"), F.col("c_mktsegment").alias("person_group"))
    have = c.where("c_custkey % 7 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, -1).otherwise(F.col("c_nationkey")).alias("vehicle_group"), F.when(F.col("c_custkey") % 4 == 0, None).otherwise(F.col("c_mktsegment")).alias("person_group"))
    return merge.reconciliation(want, have, "c_custkey", {"vehicle_group": "wrong vehicle group", "person_group": "wrong person group"})


RECONCILE = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'link' WHEN c_custkey % 5 = 0 THEN 'unlink' WHEN c_custkey % 3 = 0 THEN 'wrong vehicle group' WHEN c_custkey % 4 = 0 THEN 'wrong person group' ELSE 'none' END AS action
 FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 7 <> 0"""


def duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 6 != 0, F.col("o_custkey")).alias("who"), "o_orderdate", "o_totalprice")
    new = o.select(F.col("o_orderkey").alias("row"), "who", "o_orderdate", (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 2 == 0, 0.001).otherwise(5.0)).alias("o_totalprice"))
    return merge.duplicate_flags(new, o, ["who", "o_orderdate", "o_totalprice"], "o_orderkey", ["o_totalprice"]).select("row", F.col("stored_o_orderkey").cast("double").alias("stored"))


DUPLICATE_FLAGS = """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 6 <> 0 THEN o_custkey END AS who, o_orderdate, CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS p, CAST(round(o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 0.001 ELSE 5 END, 2) AS DECIMAL(18,2)) AS q FROM orders)
 SELECT a.o_orderkey AS row, CAST(min(b.o_orderkey) AS DOUBLE) AS stored FROM o a LEFT JOIN o b ON a.who IS NOT DISTINCT FROM b.who AND a.o_orderdate = b.o_orderdate AND a.q = b.p GROUP BY 1"""


def refreshed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month").cast("string"))
    build = lambda df: df.groupBy("month").agg(dsum("o_totalprice").alias("amount"), F.count("*").alias("n"))
    old = build(facts.where("o_orderstatus <> 'P'"))
    return merge.refreshed(old, facts, facts.where("o_orderdate >= timestamp_ntz'2001-01-01'"), "month", build)


REFRESHED_ROLLUP = """SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS amount, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' OR o_orderstatus <> 'P' GROUP BY 1"""


def content_hash_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("size"))
    first = dedupe.first_per_key(d, ["sha256"], [F.asc("doc_id")])
    return first.join(d.where("doc_id % 10 = 0").select("sha256").distinct(), "sha256", "left_anti")


CONTENT_HASH_DEDUPE = """WITH d AS (SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size FROM documents)
 SELECT sha256, min(doc_id) AS doc_id, min(size) AS size FROM d GROUP BY sha256 HAVING count(*) FILTER (doc_id % 10 = 0) = 0"""


def pivot_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months between a customer's first and last order less those with orders, by priority."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.trunc("o_orderdate", "month").alias("month"))
    per = o.groupBy("o_custkey", "o_orderpriority").agg(F.greatest(F.months_between(F.max("month"), F.min("month")) + 1 - F.count_distinct("month"), F.lit(0)).cast("double").alias("missing"))
    return reshape.pivoted(per, ["o_custkey"], "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], F.first("missing")).withColumnsRenamed({"1-URGENT": "p1", "2-HIGH": "p2", "3-MEDIUM": "p3", "4-NOT SPECIFIED": "p4", "5-LOW": "p5"})


PIVOT_MISSING = """WITH o AS (SELECT o_custkey, left(o_orderpriority, 1) AS p, date_trunc('month', o_orderdate) AS m FROM orders), g AS (SELECT o_custkey, p, CAST(greatest(date_diff('month', min(m), max(m)) + 1 - count(DISTINCT m), 0) AS DOUBLE) AS x FROM o GROUP BY 1, 2)
 SELECT o_custkey, max(x) FILTER (p = '1') AS p1, max(x) FILTER (p = '2') AS p2, max(x) FILTER (p = '3') AS p3, max(x) FILTER (p = '4') AS p4, max(x) FILTER (p = '5') AS p5 FROM g GROUP BY 1"""


QUERIES = {
    "q_conflict_dedupe": (conflict_dedupe, CONFLICT_DEDUPE),
    "q_conflict_counts": (conflict_counts, CONFLICT_COUNTS),
    "q_latest_per_column": (latest_per_column, LATEST_PER_COLUMN),
    "q_keep_extreme": (keep_extreme, KEEP_EXTREME),
    "q_first_non_null": (first_non_null, FIRST_NON_NULL),
    "q_filled_group": (filled_group, FILLED_GROUP),
    **{f"q_upsert_{mode}": _upsert(mode) for mode in merge.MODES},
    "q_upsert_protected": (protected_upsert, PROTECTED_UPSERT),
    "q_scd2_merge": (scd2, SCD2),
    "q_replace_computed": (replaced, REPLACED),
    "q_replace_source": (replaced_source, REPLACED_SOURCE),
    "q_reconcile": (reconcile, RECONCILE),
    "q_duplicate_flags": (duplicate_flags, DUPLICATE_FLAGS),
    "q_refreshed_rollup": (refreshed_rollup, REFRESHED_ROLLUP),
    "q_content_hash_dedupe": (content_hash_dedupe, CONTENT_HASH_DEDUPE),
    "q_pivot_missing": (pivot_missing, PIVOT_MISSING),
}
