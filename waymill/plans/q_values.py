"""Queries that standardise values, read text and make synthetic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.functions import standardise as st
from waymill.operators import synth, text_rows
from waymill.plans.tables import table


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    shown = F.replace(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    text = F.when(F.col("p_size") % 5 == 0, F.concat(shown, F.lit(" € TTC"))).when(F.col("p_size") % 5 == 1, F.concat(shown, F.lit("km"))).when(F.col("p_size") % 5 == 2, "n/a").otherwise(shown)
    return p.select("p_partkey", st.number(text).alias("price"), st.whole_number_text(F.col("p_size"), 4).alias("size_text"), st.implied_decimals(F.col("p_size"), 2).alias("size_hundredths"))


NUMBERS = """SELECT p_partkey, CASE WHEN p_size % 5 <> 2 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) END AS price, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_text, p_size / 100 AS size_hundredths FROM part"""


def plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    letter = lambda n: F.substring(F.lit(synth.LETTERS), (n % 26 + 1).cast("int"), F.lit(1))
    k = F.col("c_custkey")
    two, three, end = F.concat(letter(k), letter(k * 7)), F.lpad((k % 1000).cast("string"), 3, "0"), F.concat(letter(k * 3), letter(k * 5))
    raw = F.when(k % 4 == 0, F.concat(two, three, end)).when(k % 4 == 1, F.lower(F.concat_ws("-", two, three, end))).when(k % 4 == 2, F.concat(F.lit("VEC"), F.concat_ws("_", two, three, end))).otherwise(F.concat(F.lit("X "), three))
    return c.select("c_custkey", st.plate(raw).alias("plate"), st.is_missing(F.when(k % 4 == 3, "-").otherwise(raw)).alias("missing"))


PLATES = """WITH k AS (SELECT c_custkey, chr(CAST(65 + c_custkey % 26 AS INT)) || chr(CAST(65 + c_custkey * 7 % 26 AS INT)) AS a, lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS b, chr(CAST(65 + c_custkey * 3 % 26 AS INT)) || chr(CAST(65 + c_custkey * 5 % 26 AS INT)) AS c FROM customer)
 SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'X' || b ELSE a || '-' || b || '-' || c END AS plate, c_custkey % 4 = 3 AS missing FROM k"""


def phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.lpad((F.col("c_custkey") * 7919 % 100000000).cast("string"), 8, "0")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("06"), k)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("+33 (0)6 "), k)).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("0033.6."), k)).otherwise(k)
    return table(spark, sf_dir, "customer").select("c_custkey", st.phone(raw).alias("phone"))


PHONES = """WITH k AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS k FROM customer)
 SELECT c_custkey, CASE WHEN c_custkey % 4 < 3 OR (k LIKE '0%' AND length(k) = 10) THEN '06 ' || k[1:2] || ' ' || k[3:4] || ' ' || k[5:6] || ' ' || k[7:8] END AS phone FROM k"""


def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws(" ", F.initcap("p_name"), F.lit("Été-Noël"), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", st.name_key(F.col("p_name")).alias("name_key"), st.folded_name_key(name).alias("folded"), st.without_accents(name).alias("plain"))


NAME_KEYS = """WITH n AS (SELECT p_partkey, p_name, list_sort(string_split(p_name, ' ')) AS w, p_brand FROM part)
 SELECT p_partkey, array_to_string(w, ' ') AS name_key, array_to_string(list_sort(list_concat(string_split(lower(p_name), ' '), ['ete', 'noel', lower(p_brand)])), ' ') AS folded,
 array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1:1]) || lower(x[2:])), ' ') || ' Ete Noel ' || p_brand AS plain FROM n"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day = F.col("o_orderdate")
    raw = F.when(k % 4 == 0, F.date_format(day, "dd/MM/yyyy")).when(k % 4 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).when(k % 4 == 2, F.date_format(day, "dd-MM-yyyy")).otherwise("soon")
    serial = F.datediff(F.to_date(day), F.lit("1899-12-30").cast("date")).cast("double") + 0.5
    return o.select("o_orderkey", st.timestamp(raw, ("dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy")).alias("parsed"), st.excel_date(serial).cast("string").alias("excel"), st.wall_clock(F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("wall"), st.local_time(day).alias("paris"))


DATES = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate END AS parsed, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS excel, o_orderdate AS wall, timezone('Europe/Paris', timezone('UTC', o_orderdate)) AS paris FROM orders"""


def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", st.json_at(F.col("props"), "k").cast("bigint").alias("k"), st.json_wrap(F.col("event_type"), "kind", source="app").alias("wrapped"))


JSON_PATH = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{"kind":"' || event_type || '","source":"app"}' AS wrapped FROM events"""


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    code, city = F.lpad((k * 37 % 90000 + 1000).cast("string"), 5, "0"), F.element_at(F.array(*map(F.lit, ["Lyon", "Saint Denis", "Nice"])), (k % 3 + 1).cast("int"))
    street = F.concat(F.lit("rue des "), F.lower("c_mktsegment"))
    raw = F.when(k % 3 == 0, F.concat_ws(" ", (k % 99 + 1).cast("string"), street, code, city, F.lit("CEDEX 2"))).when(k % 3 == 1, F.concat_ws(", ", F.concat((k % 99 + 1).cast("string"), F.lit("bis"), F.lit(" "), street), F.concat_ws(" ", code, city))).otherwise(F.concat_ws(" ", city, code))
    return table(spark, sf_dir, "customer").select("c_custkey", st.address_parts(raw).alias("a")).select("c_custkey", "a.*")


ADDRESSES = """WITH k AS (SELECT c_custkey, CAST(c_custkey % 99 + 1 AS VARCHAR) AS n, lpad(CAST(c_custkey * 37 % 90000 + 1000 AS VARCHAR), 5, '0') AS postal_code, ['Lyon', 'Saint Denis', 'Nice'][c_custkey % 3 + 1] AS city, 'rue des ' || lower(c_mktsegment) AS s FROM customer)
 SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN n WHEN 1 THEN n || 'bis' END AS number, CASE WHEN c_custkey % 3 < 2 THEN s END AS street, postal_code, city FROM k"""


def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = st.composite_key(who=st.key_part(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))), day=st.key_part(F.col("o_orderdate"), "date"), price=st.key_part(F.col("o_totalprice"), "number"))
    return o.select("o_orderkey", key.alias("sync_key"), F.sha1(key.cast("binary")).alias("id"))


COMPOSITE_KEYS = """WITH k AS (SELECT o_orderkey, 'who:' || CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE '-' END || '|day:' || strftime(o_orderdate, '%Y-%m-%d') || '|price:' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS sync_key FROM orders) SELECT *, sha1(sync_key) AS id FROM k"""


def tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    other = F.col("l_extendedprice") * F.when(F.col("l_linenumber") % 2 == 0, 1 + 4e-6).otherwise(1.001)
    late = F.col("l_shipdate") + F.when(F.col("l_linenumber") > 3, F.expr("INTERVAL 2 DAYS")).otherwise(F.expr("INTERVAL 1 DAYS"))
    same = st.nearly_equal(F.col("l_extendedprice"), other, "number").alias("same_price"), st.nearly_equal(F.col("l_shipdate"), late, "date").alias("same_day")
    km = F.round(st.lifecycle_share(F.col("l_quantity") * 5000), 6).alias("share")
    return lines.select("l_linenumber", *same, km).groupBy("same_price", "same_day", "share").agg(F.count("*").alias("n"))


TOLERANT = """SELECT l_linenumber % 2 = 0 AS same_price, l_linenumber <= 3 AS same_day, round(CASE WHEN l_quantity * 5000 <= 0 THEN 0 WHEN l_quantity * 5000 < 50000 THEN 0.6::DOUBLE * l_quantity * 5000 / 50000 WHEN l_quantity * 5000 < 200000 THEN 0.6::DOUBLE + 0.4::DOUBLE * (l_quantity * 5000 - 50000) / 150000 ELSE 1 END, 6) AS share, count(*) AS n FROM lineitem GROUP BY ALL"""


def text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages, with the page's title carried to each."""
    lines = text_rows.lines_of(table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", "<", "\n<")), "html", ["page_id"]).withColumn("part", F.lit(1))
    fields = [text_rows.Field("title", r"<title>([^<]*)", "page", "preserve"), text_rows.Field("link", r'<a [^>]*href="([^"]*)"')]
    return text_rows.rows_from_lines(lines, "page_id", "part", fields, "link").groupBy("page_id", "title").agg(F.count("*").alias("n_links"), F.min("link").alias("least_link"))


TEXT_FIELDS = r"""WITH l AS (SELECT page_id, unnest(string_split_regex(regexp_replace(html, '<', chr(10) || '<', 'g'), '\r?\n')) AS line, generate_subscripts(string_split_regex(regexp_replace(html, '<', chr(10) || '<', 'g'), '\r?\n'), 1) AS k FROM pages),
 f AS (SELECT page_id, k, CASE WHEN regexp_matches(line, '<title>([^<]*)') THEN regexp_extract(line, '<title>([^<]*)', 1) END AS t, CASE WHEN regexp_matches(line, '<a [^>]*href="([^"]*)"') THEN regexp_extract(line, '<a [^>]*href="([^"]*)"', 1) END AS link FROM l),
 c AS (SELECT page_id, link, first_value(t IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS title FROM f)
 SELECT page_id, title, count(*) AS n_links, min(link) AS least_link FROM c WHERE link IS NOT NULL GROUP BY 1, 2"""


def role_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing category from the most frequent one of the same name, ties to the smallest."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("category"))
    usual = p.where("category IS NOT NULL").groupBy("p_name").agg(F.mode("category", True).alias("usual"))
    return p.join(usual, "p_name", "left").select("p_partkey", F.coalesce("category", "usual").alias("category"))


ROLE_CATEGORIES = """WITH p AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS category FROM part), c AS (SELECT p_name, category, count(*) AS n FROM p WHERE category IS NOT NULL GROUP BY 1, 2),
 u AS (SELECT p_name, category AS usual FROM c QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY n DESC, category) = 1) SELECT p_partkey, coalesce(category, usual) AS category FROM p LEFT JOIN u USING (p_name)"""


def oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers drawn with replacement: each draw copies them under new ids."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    sample = synth.sampled(c.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", 3000, seed=7)
    out = synth.replicated(o, sample, "o_custkey")
    return out.select("replica", synth.regenerated(F.col("o_orderkey"), F.col("replica")).alias("order_id"), "o_custkey", "o_orderdate", "o_totalprice")


def pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    alias = synth.unique_pseudonyms(c, "c_name", c.select("c_name"), seed=3)
    return c.join(alias, "c_name").select("c_custkey", "alias")


def oversample_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every customer, whoever is drawn: all orders in each draw, under new ids, and only eligible ones."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    sample = synth.sampled(c.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", 3000, seed=7)
    rows = oversample(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("rows"), F.count_distinct("order_id").alias("ids"))
    draws = sample.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("draws"))
    orders = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    met = c.join(draws, "c_custkey", "left").join(rows, "c_custkey", "left").join(orders, "c_custkey", "left").fillna(0, ["draws", "rows", "ids", "orders"])
    return met.select("c_custkey", (F.col("rows") == F.col("draws") * F.col("orders")).alias("whole"), (F.col("rows") == F.col("ids")).alias("new_ids"), ((F.col("draws") == 0) | (F.col("c_acctbal") > 0)).alias("eligible"), F.lit(sample.count()).cast("long").alias("total_draws"))


OVERSAMPLE_WHOLE = "SELECT c_custkey, true AS whole, true AS new_ids, true AS eligible, CAST(3000 AS BIGINT) AS total_draws FROM customer"


def pseudonym_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of each pseudonym, how many have it, and whether it is a real name: shapes stay, none is shared or real."""
    out = pseudonymise(spark, sf_dir)
    real = table(spark, sf_dir, "customer").select(F.col("c_name").alias("alias")).distinct().withColumn("is_real", F.lit(True))
    uses = out.groupBy("alias").agg(F.count_distinct("c_custkey").alias("n"))
    shape = F.regexp_replace(F.regexp_replace("alias", "[0-9]", "9"), "[A-Za-z]", "A")
    return out.join(real, "alias", "left").join(uses, "alias").select("c_custkey", shape.alias("shape"), "n", F.coalesce("is_real", F.lit(False)).alias("is_real"))


PSEUDONYM_SHAPES = """SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') AS shape, CAST(count(*) OVER (PARTITION BY c_name) AS BIGINT) AS n, false AS is_real FROM customer"""


QUERIES = {
    "q_std_numeric": (numbers, NUMBERS),
    "q_std_plate": (plates, PLATES),
    "q_std_phone": (phones, PHONES),
    "q_std_name_key": (name_keys, NAME_KEYS),
    "q_std_dates": (dates, DATES),
    "q_json_path": (json_path, JSON_PATH),
    "q_address_parts": (addresses, ADDRESSES),
    "q_composite_key": (composite_keys, COMPOSITE_KEYS),
    "q_tolerant_equality": (tolerant, TOLERANT),
    "q_text_field_extract": (text_fields, TEXT_FIELDS),
    "q_role_category": (role_categories, ROLE_CATEGORIES),
    "q_oversample": (oversample, None),
    "q_pseudonymise": (pseudonymise, None),
    "q_oversample_whole": (oversample_whole, OVERSAMPLE_WHOLE),
    "q_pseudonym_shapes": (pseudonym_shapes, PSEUDONYM_SHAPES),
}
