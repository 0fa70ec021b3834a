"""Queries over costs, taxes, ownership and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.operators import finance, kpi
from waymill.operators.timeseries import active_days
from waymill.plans.tables import ORDER_INTERVALS, cents, dsum, order_intervals, table


def _expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    price = F.round("l_extendedprice", 2)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.lower("p_type").alias("category"), F.year("l_shipdate").cast("bigint").alias("year"),
        F.when(F.col("l_linenumber") % 3 != 0, price).alias("amount_tax_exc"), F.when(F.col("l_linenumber") % 3 == 0, price).alias("amount_tax_inc"), F.lit(None).cast("double").alias("vat_value"))


EXPENSES = """ex AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, lower(p_type) AS category, CAST(year(l_shipdate) AS BIGINT) AS year, CASE WHEN l_linenumber % 3 <> 0 THEN round(l_extendedprice, 2) END AS e,
 CASE WHEN l_linenumber % 3 = 0 THEN round(l_extendedprice, 2) END AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
 fi AS (SELECT *, CASE WHEN category = 'promo' THEN 0.0::DOUBLE ELSE 0.2::DOUBLE END AS rate FROM ex),
 am AS (SELECT *, round(coalesce(i, e * (1 + rate)), 2) AS amount_tax_inc, round(coalesce(e, i / (1 + rate)), 2) AS amount_tax_exc FROM fi)"""


def vat_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finance.infer_amounts(_expenses(spark, sf_dir), "category", untaxed=("promo",))
    return out.groupBy("category", "year").agg(*[F.round(dsum(c) / 1000, 0).alias(c) for c in ("amount_tax_inc", "amount_tax_exc", "vat_value")], F.count("*").alias("n"))


VAT_INFER = f"""WITH {EXPENSES} SELECT category, year, round(CAST(sum(CAST(amount_tax_inc AS DECIMAL(18,4))) AS DOUBLE) / 1000, 0) AS amount_tax_inc, round(CAST(sum(CAST(amount_tax_exc AS DECIMAL(18,4))) AS DOUBLE) / 1000, 0) AS amount_tax_exc,
 round(CAST(sum(CAST(round(amount_tax_inc - amount_tax_exc, 2) AS DECIMAL(18,4))) AS DOUBLE) / 1000, 0) AS vat_value, count(*) AS n FROM am GROUP BY 1, 2"""


def deductible(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _expenses(spark, sf_dir).withColumn("vat", F.coalesce("amount_tax_exc", "amount_tax_inc") * 0.25)
    fiscal = F.when(F.col("l_suppkey") % 3 == 0, "utility").otherwise("personal")
    energy = F.when(F.col("l_suppkey") % 2 == 0, "electricity").otherwise("diesel")
    out = e.withColumn("deductible", finance.deductible_vat(fiscal, F.col("category"), energy, F.col("vat"), barred=("small", "promo"), fuel="large"))
    return out.groupBy("category").agg(F.round(dsum("deductible"), 0).alias("deductible"))


DEDUCTIBLE = f"""WITH {EXPENSES}, v AS (SELECT *, coalesce(e, i) * 0.25 AS vat FROM ex) SELECT category, round(CAST(sum(CAST(CASE WHEN l_suppkey % 3 = 0 THEN vat WHEN category IN ('small', 'promo') THEN 0
 WHEN category = 'large' THEN CASE WHEN l_suppkey % 2 = 0 THEN vat ELSE round(0.8 * vat, 2) END ELSE vat END AS DECIMAL(18,4))) AS DOUBLE), 0) AS deductible FROM v GROUP BY 1"""


def exceptional_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = order_intervals(spark, sf_dir)
    usual = iv.where("date_to IS NULL").groupBy("o_custkey").agg(F.max("o_totalprice").alias("usual"))
    rows = table(spark, sf_dir, "orders").join(usual, "o_custkey", "left")
    return rows.where(finance.exceptional(F.col("o_totalprice"), F.col("usual"), 400_000.0)).select("o_orderkey")


EXCEPTIONAL_AMOUNT = f"WITH {ORDER_INTERVALS}, u AS (SELECT o_custkey, max(o_totalprice) AS usual FROM iv WHERE date_to IS NULL GROUP BY 1) SELECT o_orderkey FROM orders LEFT JOIN u USING (o_custkey) WHERE CASE WHEN usual IS NOT NULL THEN o_totalprice > 2 * usual ELSE o_totalprice > 400000 END"


def category_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _expenses(spark, sf_dir).withColumn("amount", F.coalesce("amount_tax_exc", "amount_tax_inc"))
    return finance.category_sums(e, ["l_partkey", "year"], "category", "amount", {"rent": ["small", "medium"], "energy": ["large"], "other": ["promo", "economy", "standard"]})


CATEGORY_SUMS = f"""WITH {EXPENSES}, a AS (SELECT *, CAST(coalesce(e, i) AS DECIMAL(18,4)) AS amount FROM ex) SELECT l_partkey, year, CAST(sum(CASE WHEN category IN ('small', 'medium') THEN amount ELSE 0 END) AS DOUBLE) AS rent,
 CAST(sum(CASE WHEN category = 'large' THEN amount ELSE 0 END) AS DOUBLE) AS energy, CAST(sum(CASE WHEN category IN ('promo', 'economy', 'standard') THEN amount ELSE 0 END) AS DOUBLE) AS other FROM a GROUP BY 1, 2"""


def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of ownership of each part in 1998: spend, held days from its lines' orders, write-off and benefit."""
    low, high = F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date")
    orders = order_intervals(spark, sf_dir)
    days = orders.groupBy("o_custkey").agg(F.sum(active_days(F.col("date_from"), F.col("date_to"), low, high)).cast("double").alias("days"))
    spend = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1998).groupBy("o_custkey").agg(dsum("o_totalprice").alias("spend"), F.count("*").alias("n_orders"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 8 != 0, F.col("c_mktsegment")).alias("segment"), (F.col("c_acctbal") + 30000).alias("price"), (F.col("c_custkey") % 200).alias("co2"))
    met = people.join(days, "o_custkey", "left").join(spend, "o_custkey", "left")
    d, price = F.coalesce("days", F.lit(0.0)), F.col("price")
    nda = finance.amortisation_base(d, price, F.col("co2"))
    ikb = F.least(finance.benefit_by_price(d, price, F.lit(0.0)), finance.benefit_by_expenses(F.coalesce("spend", F.lit(0.0)), F.lit(0.0)))
    tco = F.coalesce("spend", F.lit(0.0)) + kpi.CORPORATE_RATE * nda + kpi.SOCIAL_RATE * ikb
    return met.select("o_custkey", "segment", "n_orders", d.alias("days"), nda.alias("amortisation"), ikb.alias("benefit"), tco.alias("tco"))


YEARLY = f"""{ORDER_INTERVALS},
 dy AS (SELECT o_custkey, CAST(sum(greatest(date_diff('day', greatest(CAST(date_from AS DATE), DATE '1998-01-01'), least(coalesce(CAST(date_to AS DATE), DATE '1998-12-31'), DATE '1998-12-31')) + 1, 0)) AS DOUBLE) AS days FROM iv GROUP BY 1),
 sp AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS spend FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1),
 p AS (SELECT c_custkey AS o_custkey, CASE WHEN c_custkey % 8 <> 0 THEN c_mktsegment END AS segment, c_acctbal + 30000 AS price, c_custkey % 200 AS co2, coalesce(days, 0) AS days, coalesce(spend, 0) AS spend FROM customer LEFT JOIN dy ON dy.o_custkey = c_custkey LEFT JOIN sp ON sp.o_custkey = c_custkey),
 q AS (SELECT *, greatest(days / (5 * 365) * (price - CASE WHEN co2 < 20 THEN 30000 WHEN co2 < 50 THEN 20300 WHEN co2 < 160 THEN 18300 ELSE 9900 END), 0) AS amortisation,
  least(greatest(0.09::DOUBLE * price * days / 365, 0), greatest(0.3::DOUBLE * spend, 0)) AS benefit FROM p),
 t AS (SELECT *, spend + 0.25 * amortisation + 0.48 * benefit AS tco FROM q)"""


def tco_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _yearly(spark, sf_dir).select("o_custkey", "days", *[F.round(c, 1).alias(c) for c in ("amortisation", "benefit", "tco")])


TCO_YEAR = f"WITH {YEARLY} SELECT o_custkey, days, round(amortisation, 1) AS amortisation, round(benefit, 1) AS benefit, round(tco, 1) AS tco FROM t"


def tco_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = _yearly(spark, sf_dir).withColumn("ratio", F.try_divide("tco", "days"))
    met = finance.median_by(ratio, ["segment"], "ratio", "usual")
    return met.groupBy("segment", finance.ratio_flags(F.col("ratio"), F.col("usual")).alias("flag")).agg(F.count("*").alias("n"))


TCO_FLAGS = f"""WITH {YEARLY}, r AS (SELECT coalesce(segment, 'NA') AS segment, CASE WHEN days <> 0 THEN tco / days END AS ratio FROM t), m AS (SELECT segment, median(ratio) AS usual FROM r GROUP BY 1)
 SELECT segment, CASE WHEN ratio IS NULL OR usual IS NULL THEN NULL WHEN ratio < 0.7::DOUBLE * usual THEN 'low' WHEN ratio > 1.3::DOUBLE * usual THEN 'high' ELSE 'ok' END AS flag, count(*) AS n FROM r JOIN m USING (segment) GROUP BY ALL"""


def cost_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf_dir, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.rollup("n_name", "l_returnflag").agg(dsum("l_extendedprice").alias("amount"), F.count("*").alias("n"))


COST_ROLLUP = """SELECT n_name, l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS amount, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ROLLUP (n_name, l_returnflag)"""


def kpi_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas over a supplier's year, every primitive in one grouping."""
    e = _expenses(spark, sf_dir).select("l_suppkey", "year", "category", F.coalesce("amount_tax_exc", "amount_tax_inc").alias("amount_tax_exc"), F.col("l_partkey").alias("vehicle_id"), F.col("l_orderkey").alias("driver_id"))
    facts = e.withColumns({"net_amount": F.col("amount_tax_exc"), "deductible_vat": F.lit(0.0)})
    rent, energy = kpi.leaf("expense", ["small", "medium"], "net"), kpi.leaf("expense", "large", "tax_exc")
    tco = kpi.block(rent, "+", energy)
    formulas = {"rent": rent, "energy": energy, "tco": tco, "tco_per_vehicle": kpi.block(tco, "/", kpi.leaf("total-vehicles")), "taxed": kpi.block(kpi.constant(kpi.SOCIAL_RATE), "x", kpi.block(tco, "-", energy)), "no_rate": {"left": kpi.constant(2), "right": {"operator": None, "element": kpi.leaf("total-drivers")}}}
    return kpi.evaluate(facts, ["l_suppkey", "year"], formulas).withColumns({c: F.round(c, 4) for c in ("tco_per_vehicle", "taxed", "tco")})


KPI_TREE = f"""WITH {EXPENSES}, a AS (SELECT l_suppkey, year, CAST(sum(CASE WHEN category IN ('small', 'medium') THEN CAST(coalesce(e, i) AS DECIMAL(18,4)) END) AS DOUBLE) AS rent, CAST(sum(CASE WHEN category = 'large' THEN CAST(coalesce(e, i) AS DECIMAL(18,4)) END) AS DOUBLE) AS energy,
  CAST(count(DISTINCT l_partkey) AS DOUBLE) AS v, CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS d FROM ex GROUP BY 1, 2)
 SELECT l_suppkey, year, rent, energy, round(rent + energy, 4) AS tco, round((rent + energy) / nullif(v, 0), 4) AS tco_per_vehicle, round(0.48 * (rent + energy - energy), 4) AS taxed, 2.0 * d AS no_rate FROM a"""


def kpi_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _expenses(spark, sf_dir)
    facts = finance.infer_amounts(e.withColumn("deductible_vat", F.round(F.coalesce("amount_tax_exc", "amount_tax_inc") * 0.1, 2)), "category", untaxed=())
    out = kpi.evaluate(facts, ["year"], kpi.family("expense", "cost", {"rent": ["small", "medium"], "energy": ["large"]}))
    return out.withColumns({c: F.round(c, 0) for c in out.columns if c != "year"})


KPI_FAMILY = f"""WITH {EXPENSES}, g AS (SELECT *, round(coalesce(i, e * 1.2::DOUBLE), 2) AS inc, round(coalesce(e, i / 1.2::DOUBLE), 2) AS exc, round(coalesce(e, i) * 0.1, 2) AS ded FROM ex),
 n AS (SELECT year, category, CAST(exc AS DECIMAL(18,4)) AS x, CAST(ded AS DECIMAL(18,4)) AS d, CAST(round(inc - ded, 2) AS DECIMAL(18,4)) AS n FROM g)
 SELECT year, round(CAST(sum(x) FILTER (category IN ('small', 'medium')) AS DOUBLE), 0) AS cost_rent_tax_exc, round(CAST(sum(d) FILTER (category IN ('small', 'medium')) AS DOUBLE), 0) AS cost_rent_deduc_vat, round(CAST(sum(n) FILTER (category IN ('small', 'medium')) AS DOUBLE), 0) AS cost_rent_net,
 round(CAST(sum(x) FILTER (category = 'large') AS DOUBLE), 0) AS cost_energy_tax_exc, round(CAST(sum(d) FILTER (category = 'large') AS DOUBLE), 0) AS cost_energy_deduc_vat, round(CAST(sum(n) FILTER (category = 'large') AS DOUBLE), 0) AS cost_energy_net FROM n GROUP BY 1"""


def kpi_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilometres of a supplier's parts as odometers: spans and latest readings by vehicle, summed, and cost a kilometre."""
    facts = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").alias("vehicle_id"), F.round("l_extendedprice", 2).alias("mileage"), F.col("l_shipdate").alias("mileage_date"), F.lit("all").alias("category"), F.col("l_quantity").alias("net_amount"))
    km = kpi.leaf("total-mileage")
    formulas = {"total_km": km, "current_km": kpi.leaf("current-mileage"), "cost_per_km": kpi.block(kpi.leaf("expense", ["all"], "net"), "/", km)}
    return kpi.evaluate(facts, ["l_suppkey"], formulas).withColumns({c: F.round(c, 6 if c == "cost_per_km" else 2) for c in formulas})


KPI_MILEAGE = """WITH v AS (SELECT l_suppkey, l_partkey, max(round(l_extendedprice, 2)) - min(round(l_extendedprice, 2)) AS km, arg_max(round(l_extendedprice, 2), (l_shipdate, round(l_extendedprice, 2))) AS now FROM lineitem GROUP BY 1, 2),
 k AS (SELECT l_suppkey, CAST(sum(CAST(km AS DECIMAL(18,4))) AS DOUBLE) AS km, CAST(sum(CAST(now AS DECIMAL(18,4))) AS DOUBLE) AS now FROM v GROUP BY 1),
 e AS (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS cost FROM lineitem GROUP BY 1)
 SELECT l_suppkey, round(km, 2) AS total_km, round(now, 2) AS current_km, round(cost / nullif(km, 0), 6) AS cost_per_km FROM e JOIN k USING (l_suppkey)"""


def star_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expenses with labels of all their dimensions, by region and month."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    c, s, n, r = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation", "region"))
    places = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name")
    met = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(F.broadcast(places.select(F.col("n_nationkey").alias("sk"), F.col("r_name").alias("supplier_region"))), F.col("s_nationkey") == F.col("sk"), "left")
    )
    return met.groupBy(F.coalesce("r_name", F.lit("unknown")).alias("region"), F.coalesce("supplier_region", F.lit("unknown")).alias("supplier_region"), F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.sum(cents("l_extendedprice")).cast("double").alias("amount"), F.count("*").alias("n"))


STAR_REPORT = """SELECT coalesce(r1.r_name, 'unknown') AS region, coalesce(r2.r_name, 'unknown') AS supplier_region, strftime(l_shipdate, '%Y-%m') AS month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS amount, count(*) AS n
 FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation n1 ON c_nationkey = n1.n_nationkey LEFT JOIN region r1 ON n1.n_regionkey = r1.r_regionkey
 LEFT JOIN nation n2 ON s_nationkey = n2.n_nationkey LEFT JOIN region r2 ON n2.n_regionkey = r2.r_regionkey GROUP BY 1, 2, 3"""

QUERIES = {
    "q_vat_infer": (vat_infer, VAT_INFER),
    "q_deductible_vat": (deductible, DEDUCTIBLE),
    "q_exceptional_amount": (exceptional_amount, EXCEPTIONAL_AMOUNT),
    "q_category_sums": (category_sums, CATEGORY_SUMS),
    "q_tco_year": (tco_year, TCO_YEAR),
    "q_tco_flags": (tco_flags, TCO_FLAGS),
    "q_cost_rollup": (cost_rollup, COST_ROLLUP),
    "q_kpi_tree": (kpi_tree, KPI_TREE),
    "q_kpi_family": (kpi_family, KPI_FAMILY),
    "q_kpi_mileage": (kpi_mileage, KPI_MILEAGE),
    "q_star_report": (star_report, STAR_REPORT),
}
