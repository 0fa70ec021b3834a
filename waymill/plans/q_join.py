"""Queries over intervals, lookups, hierarchies, neighbours and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators import joins, names, reshape, spatial
from waymill.operators.merge import path_ids
from waymill.plans.tables import ORDER_INTERVALS, SHIPMENTS, order_intervals, shipments, table

SHIP = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
COLS = ", ".join(SHIP)


def _interval(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    facts = shipments(spark, sf_dir).withColumn("l_shipdate", F.col("l_shipdate") - F.expr("INTERVAL 300 DAYS"))
    iv = order_intervals(spark, sf_dir).withColumnRenamed("o_orderkey", "version")
    out = joins.best_interval(facts, iv, "o_custkey", "l_shipdate", "date_from", "date_to", values=["version"], **how)
    return out.select(*SHIP, F.col("version").cast("double").alias("version"), "matched")


def interval_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval(spark, sf_dir, order=[("__start", True), ("version", False)])


def interval_halfopen_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval(spark, sf_dir, order=[("__start", True), ("version", False)], closed=False, fallback=[("__start", True), ("version", False)])


def interval_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval(spark, sf_dir, order=[("__start", True), ("version", False)], fallback=[("__start", False), ("version", False)], mask_fallback=True)


def interval_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval(spark, sf_dir, order=[("__start", False), ("version", False)]).where("matched").drop("matched")


def _interval_sql(closed: bool, order: str, fallback: str | None, value: str, where: str, last: str) -> str:
    inside = f"(l_shipdate >= date_from AND (date_to IS NULL OR l_shipdate {'<=' if closed else '<'} date_to))"
    on = "" if fallback else f" AND {inside}"
    return f"""WITH {ORDER_INTERVALS}, {SHIPMENTS}, n AS (SELECT o_custkey, {COLS.replace('l_shipdate', 'l_shipdate - INTERVAL 300 DAYS AS l_shipdate')}, row_number() OVER () AS id FROM sh),
 m AS (SELECT n.*, o_orderkey, date_from, coalesce({inside}, false) AS matched FROM n LEFT JOIN iv ON n.o_custkey = iv.o_custkey{on}),
 r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY matched DESC, CASE WHEN matched THEN date_from END {order} NULLS LAST, CASE WHEN matched THEN o_orderkey END{', ' + fallback if fallback else ''}) AS k FROM m)
 SELECT {COLS}, CAST({value} AS DOUBLE) AS version{last} FROM r WHERE k = 1 {where}"""


INCLUSIVE = _interval_sql(True, "DESC", None, "o_orderkey", "", ", matched")
HALFOPEN = _interval_sql(False, "DESC", "date_from DESC, o_orderkey", "o_orderkey", "", ", matched")
MASKED = _interval_sql(True, "DESC", "date_from, o_orderkey", "CASE WHEN matched THEN o_orderkey END", "", ", matched")
EARLIEST = _interval_sql(True, "ASC", None, "o_orderkey", "AND matched", "")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("label"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label"))
    return joins.enrich(customers, nations, ["c_nationkey"], ["label"]).select("c_custkey", "label")


ENRICHED = "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, n_name) AS label FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"


def unique_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = joins.unique_only(table(spark, sf_dir, "part").select(F.concat_ws("|", "p_name", "p_brand").alias("key"), F.col("p_partkey").alias("found")), ["key"])
    asked = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("|", "p_name", "p_brand").alias("key"))
    return joins.checked_join(asked, parts, ["key"]).select("p_partkey", F.col("found").cast("double").alias("found"))


UNIQUE_LOOKUP = """WITH k AS (SELECT p_partkey, p_name || '|' || p_brand AS key FROM part), u AS (SELECT key, min(p_partkey) AS found FROM k GROUP BY key HAVING count(*) = 1)
 SELECT p_partkey, CAST(found AS DOUBLE) AS found FROM k LEFT JOIN u USING (key)"""


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


KEY_VIOLATIONS = "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def semi_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").withColumn("owner", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")))
    direct = orders.where("owner IS NOT NULL").join(chosen, F.col("owner") == chosen["o_custkey"], "left_semi")
    other = orders.where("owner IS NULL").join(chosen, "o_custkey", "left_semi").select(orders.columns)
    return direct.unionByName(other).select("o_orderkey", F.col("owner").cast("double").alias("owner"))


SEMI_SAMPLE = """WITH o AS (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS owner FROM orders)
 SELECT o_orderkey, CAST(owner AS DOUBLE) AS owner FROM o WHERE EXISTS (SELECT 1 FROM customer WHERE c_acctbal > 5000 AND c_custkey = coalesce(owner, o_custkey))"""


def anti_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    stored = parts.where("p_size <= 40").select("p_name", "p_brand", "p_type").distinct()
    return joins.not_in(parts.select("p_name", "p_brand", "p_type", "p_partkey"), stored, ["p_name", "p_brand", "p_type"])


ANTI_EXISTING = """SELECT p_name, p_brand, p_type, p_partkey FROM part p WHERE NOT EXISTS
 (SELECT 1 FROM part s WHERE s.p_size <= 40 AND s.p_name = p.p_name AND s.p_brand = p.p_brand AND s.p_type = p.p_type)"""


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region > nation > supplier as one adjacency list."""
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("n"), "s_nationkey").alias("parent"))
    return r.unionByName(n).unionByName(s)


def hierarchy_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.paths(_places(spark, sf_dir), "id", "name", "parent").withColumn("depth", F.col("depth").cast("bigint"))


HIERARCHY_PATH = """WITH RECURSIVE t AS (SELECT 'r' || r_regionkey AS id, r_name AS name, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation UNION ALL SELECT 's' || s_suppkey, s_name, 'n' || s_nationkey FROM supplier),
 p AS (SELECT id, name AS path, CAST(1 AS BIGINT) AS depth FROM t WHERE parent IS NULL UNION ALL SELECT t.id, p.path || ' > ' || t.name, p.depth + 1 FROM t JOIN p ON t.parent = p.id) SELECT * FROM p"""


def hierarchy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_ids(joins.paths(_places(spark, sf_dir), "id", "name", "parent").where("depth = 3").select("path"), "path")


HIERARCHY_IDS = """WITH p AS (SELECT r_name, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 l AS (SELECT DISTINCT r_name AS name, r_name AS path, NULL AS parent FROM p UNION SELECT n_name, r_name || ' > ' || n_name, r_name FROM p UNION SELECT s_name, r_name || ' > ' || n_name || ' > ' || s_name, r_name || ' > ' || n_name FROM p)
 SELECT md5(path) AS id, name, path, md5(parent) AS parent_id FROM l"""


def nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 97 + F.col("c_acctbal") % 1).alias("x"), (F.col("c_custkey") % 89 + F.col("c_acctbal") * 10 % 1).alias("y"))
    places = table(spark, sf_dir, "supplier").select(F.col("s_name"), (F.col("s_suppkey") * 7 % 101).cast("double").alias("px"), (F.col("s_suppkey") * 13 % 103).cast("double").alias("py"))
    out = spatial.nearest(points, places, "c_custkey", "x", "y", "s_name", "px", "py")
    return out.select(F.col("id").alias("c_custkey"), F.col("place").alias("s_name"), F.round("distance", 6).alias("distance"))


NEAREST_PLACE = """WITH c AS (SELECT c_custkey, c_custkey % 97 + c_acctbal % 1 AS x, c_custkey % 89 + c_acctbal * 10 % 1 AS y FROM customer), s AS (SELECT s_name, CAST(s_suppkey * 7 % 101 AS DOUBLE) AS px, CAST(s_suppkey * 13 % 103 AS DOUBLE) AS py FROM supplier),
 d AS (SELECT c_custkey, s_name, sqrt((px - x) * (px - x) + (py - y) * (py - y)) AS distance FROM c, s)
 SELECT c_custkey, arg_min(s_name, (distance, s_name)) AS s_name, round(min(distance), 6) AS distance FROM d GROUP BY 1"""


def fuzzy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_brand"), F.lower("p_type")).alias("name"))
    return joins.similar_names(names, "p_partkey", "name", 95.0)


FUZZY_NAMES = """WITH n AS (SELECT p_partkey AS id, list_distinct(string_split(lower(p_name || ' ' || p_brand || ' ' || p_type), ' ')) AS t FROM part),
 p AS (SELECT a.id AS id_a, b.id AS id_b, CASE WHEN len(a.t) <= len(b.t) THEN a.t ELSE b.t END AS u, CASE WHEN len(a.t) <= len(b.t) THEN b.t ELSE a.t END AS v FROM n a JOIN n b ON a.id < b.id AND list_has_any(list_transform(a.t, lambda x: x[1:2]), list_transform(b.t, lambda x: x[1:2]))),
 s AS (SELECT id_a, id_b, round(list_avg(list_transform(u, lambda x: list_max(list_transform(v, lambda y: 100 * (1 - levenshtein(x, y) / greatest(length(x), length(y), 1)))))), 6) AS score FROM p) SELECT * FROM s WHERE score > 95"""


def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of suppliers and of parts alike by the usual threshold."""
    s, p = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name")), table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    return joins.similar_names(s.unionByName(p).distinct().withColumn("id", F.col("name")), "id", "name", 80.0)


#: All pairs of names, none left out beforehand.
SIMILAR_NAMES = """WITH n AS (SELECT DISTINCT name AS id, list_distinct(string_split(lower(name), ' ')) AS t FROM (SELECT s_name AS name FROM supplier UNION SELECT p_name FROM part)),
 p AS (SELECT a.id AS id_a, b.id AS id_b, CASE WHEN len(a.t) <= len(b.t) THEN a.t ELSE b.t END AS u, CASE WHEN len(a.t) <= len(b.t) THEN b.t ELSE a.t END AS v FROM n a JOIN n b ON a.id < b.id),
 s AS (SELECT id_a, id_b, round(list_avg(list_transform(u, lambda x: list_max(list_transform(v, lambda y: 100 * (1 - levenshtein(x, y) / greatest(length(x), length(y), 1)))))), 6) AS score FROM p) SELECT * FROM s WHERE score > 80"""


def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name and brand, token by token, are found in another one's brand and name."""
    part = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.concat_ws(", ", F.lower("p_brand"), "p_name").alias("alternative"))
    return names.duplicate_names(part, "name", "alternative", 80.0).select("name", "other", F.round("score", 6).alias("score"))


#: All pairs of a token and a name, all windows of each; a common subsequence by bits, as many as the shorter text has letters.
DUPLICATE_NAMES = r"""WITH x AS (SELECT DISTINCT p_name || ' ' || p_brand AS name, lower(p_brand) || ', ' || p_name AS alt FROM part),
 n AS (SELECT name, list_filter(list_transform(string_split(name, ' '), lambda t: array_to_string(list_sort(string_split_regex(trim(regexp_replace(lower(t), '\W', ' ', 'g')), '\s+')), ' ')), lambda t: t <> '') AS ts,
   array_to_string(list_sort(string_split_regex(trim(regexp_replace(alt, '\W', ' ', 'g')), '\s+')), ' ') AS a FROM x),
 p AS (SELECT t, a FROM (SELECT DISTINCT unnest(ts) AS t FROM n), (SELECT DISTINCT a FROM n)),
 d AS (SELECT t, a, CASE WHEN length(t) <= length(a) THEN t ELSE a END AS s, CASE WHEN length(t) <= length(a) THEN a ELSE t END AS l FROM p
  UNION ALL SELECT t, a, a, t FROM p WHERE length(t) = length(a)),
 m AS (SELECT t, a, length(s) AS k, length(l) AS n, list_transform(range(1, length(l) + 1), lambda j: list_sum(list_transform(range(length(s)), lambda i: CASE WHEN s[i + 1] = l[j] THEN CAST(1 AS BIGINT) << i ELSE 0 END))::BIGINT) AS masks FROM d),
 w AS (SELECT t, a, k, masks[greatest(i, 0) + 1 : least(n, i + k)] AS own FROM (SELECT *, unnest(range(1 - k, n)) AS i FROM m)),
 r AS (SELECT t, a, max(200.0 * (k - bit_count(list_reduce(list_prepend((CAST(1 AS BIGINT) << k) - 1, own), lambda v, b: ((v + (v & b)) | (v - (v & b))) & ((CAST(1 AS BIGINT) << k) - 1)))) / (k + len(own))) AS ratio FROM w GROUP BY t, a),
 e AS (SELECT name, a, avg(ratio) AS score FROM (SELECT name, unnest(ts) AS t FROM n) JOIN r USING (t) WHERE ratio > 0 GROUP BY name, a HAVING avg(ratio) > 80)
 SELECT e.name, n.name AS other, round(max(score), 6) AS score FROM e JOIN n ON e.a = n.a AND e.name <> n.name GROUP BY ALL"""


def multi_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their place in their clerk-facing order: priority up, price down, then key, by status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return reshape.placed(orders, ["o_orderstatus"], [("o_orderpriority", False), ("o_totalprice", True), ("o_orderkey", False)], "place")


MULTI_SORT = """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST) AS place FROM orders"""


def regex_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("steel", "steel|ring", "metal"), ("big", "^(big|large)", "bulky"), ("red", "red", "colour")], "name string, pattern string, target string")
    items = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return joins.routed(items, rules, "name", "pattern", "target", "p_name").select("p_partkey", "rule", "target", F.col("n_rules").cast("bigint").alias("n_rules"))


REGEX_ROUTING = """WITH r(name, pattern, target) AS (VALUES ('steel', 'steel|ring', 'metal'), ('big', '^(big|large)', 'bulky'), ('red', 'red', 'colour'))
 SELECT p_partkey, name AS rule, target, count(name) OVER (PARTITION BY p_partkey) AS n_rules FROM part LEFT JOIN r ON regexp_matches(p_name, pattern)"""


def melted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.long(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "value")


MELTED = "UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME measure VALUE value"


def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(", ", F.replace("p_name", F.lit(" "), F.lit(", ")), "p_brand").alias("label"))
    return reshape.exploded(lists, "label")


EXPLODED = "SELECT p_partkey, trim(unnest(string_split(replace(p_name, ' ', ', ') || ', ' || p_brand, ','))) AS label FROM part"


def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("kind"))
    return reshape.union_all([a, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))]).distinct().withColumn("nation", F.col("nation").cast("bigint"))


UNION_DISTINCT = "SELECT CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS kind FROM customer UNION SELECT s_nationkey, NULL FROM supplier"


def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    both, only = c.intersect(s).withColumn("side", F.lit("both")), c.exceptAll(s).distinct().withColumn("side", F.lit("customers over"))
    return both.unionByName(only).withColumn("nation", F.col("nation").cast("bigint"))


SET_OPERATIONS = """WITH c AS (SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000), s AS (SELECT s_nationkey AS nation FROM supplier)
 SELECT CAST(nation AS BIGINT) AS nation, 'both' AS side FROM (SELECT nation FROM c INTERSECT SELECT nation FROM s) UNION ALL SELECT DISTINCT CAST(nation AS BIGINT), 'customers over' FROM (SELECT nation FROM c EXCEPT ALL SELECT nation FROM s)"""


QUERIES = {
    "q_interval_inclusive": (interval_inclusive, INCLUSIVE),
    "q_interval_halfopen_fallback": (interval_halfopen_fallback, HALFOPEN),
    "q_interval_masked": (interval_masked, MASKED),
    "q_interval_earliest": (interval_earliest, EARLIEST),
    "q_enrich": (enriched, ENRICHED),
    "q_unique_lookup": (unique_lookup, UNIQUE_LOOKUP),
    "q_key_violations": (key_violations, KEY_VIOLATIONS),
    "q_semi_sample": (semi_sample, SEMI_SAMPLE),
    "q_anti_existing": (anti_existing, ANTI_EXISTING),
    "q_hierarchy_path": (hierarchy_path, HIERARCHY_PATH),
    "q_path_ids": (hierarchy_ids, HIERARCHY_IDS),
    "q_nearest": (nearest_place, NEAREST_PLACE),
    "q_similar_names": (similar_names, SIMILAR_NAMES),
    "q_duplicate_names": (duplicate_names, DUPLICATE_NAMES),
    "q_multi_sort": (multi_sort, MULTI_SORT),
    "q_fuzzy_names": (fuzzy_names, FUZZY_NAMES),
    "q_regex_routing": (regex_routing, REGEX_ROUTING),
    "q_melt": (melted, MELTED),
    "q_explode": (exploded, EXPLODED),
    "q_union_distinct": (union_distinct, UNION_DISTINCT),
    "q_set_operations": (set_operations, SET_OPERATIONS),
}
