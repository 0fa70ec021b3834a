"""Queries through mapping tables, surrogate keys, fallbacks and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators import lookup
from waymill.plans.tables import ORDER_INTERVALS, order_intervals, table


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'FURNITURE'").select(F.lower("c_mktsegment").alias("key"), F.concat(F.lit("seg-"), F.substring("c_mktsegment", 1, 4)).alias("value")).distinct()


def mapped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), F.initcap("c_mktsegment")).alias("loose"), F.col("c_mktsegment").alias("strict"))
    loose = lookup.mapped(c, "loose", _segments(spark, sf_dir), "key", "value")
    return lookup.mapped(loose, "strict", _segments(spark, sf_dir), "key", "value", enforce=True)


MAPPED_VALUES = """SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN ' Furniture' ELSE 'seg-' || left(c_mktsegment, 4) END AS loose, CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'seg-' || left(c_mktsegment, 4) END AS strict FROM customer"""


def uncovered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.uncovered(table(spark, sf_dir, "customer"), "c_mktsegment", _segments(spark, sf_dir), "key")


UNCOVERED_VALUES = "SELECT c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment = 'FURNITURE' GROUP BY 1"


def grown_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    known = p.where("p_size <= 5").select(lookup.folded_name_key(F.col("p_name")).alias("name_key")).distinct().withColumn("name_value", F.lit("known"))
    return lookup.grown_names(p, "p_name", known)


GROWN_NAMES = """WITH n AS (SELECT array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') AS name_key, min(p_size) AS s FROM part GROUP BY 1) SELECT name_key, CASE WHEN s <= 5 THEN 'known' ELSE name_key END AS name_value FROM n"""


def found_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest brand of the parts that a line of words names."""
    p = table(spark, sf_dir, "part")
    keys = p.select(F.regexp_replace("p_brand", "#", " ").alias("key"), "p_brand").unionByName(p.select(F.col("p_name").alias("key"), F.lit("name").alias("p_brand"))).distinct()
    texts = p.select("p_partkey", F.concat_ws("; ", F.lit("See"), F.upper("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")), F.lit("x")).alias("text"))
    return lookup.found_in_text(texts, "text", "p_partkey", keys, "key", "p_brand", "found").select("p_partkey", "found")


FOUND_IN_TEXT = """WITH k AS (SELECT DISTINCT lower(replace(p_brand, '#', ' ')) AS key, p_brand AS value FROM part UNION SELECT lower(p_name), 'name' FROM part),
 t AS (SELECT p_partkey, ' ' || regexp_replace(lower('See; ' || p_brand || CASE WHEN p_size % 2 = 0 THEN '; ' || p_name ELSE '' END || '; x'), '[^a-z0-9]+', ' ', 'g') || ' ' AS text FROM part),
 m AS (SELECT p_partkey, value, row_number() OVER (PARTITION BY p_partkey ORDER BY length(key) DESC, key) AS r FROM t JOIN k ON contains(text, ' ' || key || ' '))
 SELECT t.p_partkey, value AS found FROM t LEFT JOIN m ON t.p_partkey = m.p_partkey AND r = 1"""


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 9 != 0, F.col("p_brand")).alias("p_brand"), "p_type")
    facts, parents = lookup.surrogate_keys(p, ["p_brand", "p_type"], "model_id")
    return facts.join(parents.select(F.col("id").alias("model_id"), F.col("p_type").alias("model_type")), "model_id", "left").select("p_partkey", "model_id", "model_type")


SURROGATE_KEYS = """SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN sha256('{"p_brand":"' || p_brand || '","p_type":"' || p_type || '"}') END AS model_id, CASE WHEN p_size % 9 <> 0 THEN p_type END AS model_type FROM part"""


def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cost centre from the order, else its customer, else the customer's nation."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left").select("o_orderkey", "o_custkey", F.col("c_nationkey").alias("n_nationkey"), F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("centre"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("v"))
    return lookup.first_known(o, "centre", [(c, "o_custkey", "v"), (table(spark, sf_dir, "nation"), "n_nationkey", "n_name")]).select("o_orderkey", "centre")


FALLBACK_CHAIN = """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END, CASE WHEN c_acctbal > 0 THEN c_mktsegment END, n_name) AS centre FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


def tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region and nation trees as JSON, taken apart again."""
    n = table(spark, sf_dir, "nation").select("n_regionkey", F.struct(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name")).alias("node"))
    trees = table(spark, sf_dir, "region").join(n.groupBy("n_regionkey").agg(F.collect_list("node").alias("children")), F.col("r_regionkey") == F.col("n_regionkey"))
    return lookup.tree_edges(trees.select(F.to_json(F.struct(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), "children")).alias("tree")), "tree")


TREE_EDGES = """SELECT 'r' || r_regionkey AS id, r_name AS name, NULL AS parent FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region)"""


def oldest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.ranked_oldest(order_intervals(spark, sf_dir), ["o_custkey"], "date_from", "o_orderkey").select("o_custkey", "o_orderkey", "date_from")


OLDEST_VERSION = f"WITH {ORDER_INTERVALS} SELECT o_custkey, arg_min(o_orderkey, (date_from, o_orderkey)) AS o_orderkey, min(date_from) AS date_from FROM iv GROUP BY 1"


def active_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    active = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return lookup.active_wins(active, c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "id")


ACTIVE_WINS = "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)"

QUERIES = {
    "q_mapped_values": (mapped_values, MAPPED_VALUES),
    "q_uncovered_values": (uncovered_values, UNCOVERED_VALUES),
    "q_grown_names": (grown_names, GROWN_NAMES),
    "q_found_in_text": (found_in_text, FOUND_IN_TEXT),
    "q_surrogate_keys": (surrogate_keys, SURROGATE_KEYS),
    "q_fallback_chain": (fallback_chain, FALLBACK_CHAIN),
    "q_tree_edges": (tree_edges, TREE_EDGES),
    "q_oldest_version": (oldest_version, OLDEST_VERSION),
    "q_active_wins": (active_wins, ACTIVE_WINS),
}
