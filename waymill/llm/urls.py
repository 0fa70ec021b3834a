"""URL filters: allow and block rules, and for the rest logistic regression on hashed character n-grams.

Everything is DataFrame functions. The model is an array of ``BUCKETS`` weights and an intercept: the
features of a URL are the distinct hashed n-grams of its host and of its path, scaled to length one.
Training reads a small labelled table: at most ``LABELLED`` rows, those of least hash, which is the bound
of the classifier's sample. A step is one grouping by bucket that returns at most that many sums.

A null URL or one without ``://`` has an empty host and path; an empty part has its two end marks only.
Repeated rows are judged alike. With labels of one kind only, that kind is every verdict; with none, allow.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.llm.common import cut_lineage

#: (action, host and path); a rule holds for its host, all subdomains, and paths that start with its path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
BUCKETS, GRAMS = 2048, (2, 3, 4)
#: Labelled rows that training reads at most; its steps, first step size and weight of the square penalty.
LABELLED, STEPS, RATE, PENALTY = 4096, 25, 1.0, 1e-4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct<rule, action> of the longest rule that fits; null if none does. The rules are a short list."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def grams(part: str, letters: Column, n: int) -> Column:
    """The buckets of the runs of n letters of one part."""
    starts = F.filter(F.sequence(F.lit(1), F.size(letters)), lambda i: i <= F.size(letters) - (n - 1))
    return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.concat(F.lit(f"{part}{n}:"), *[F.element_at(letters, i + k) for k in range(n)])), F.lit(BUCKETS)).cast("int"))


def part_buckets(part: str, text: Column) -> Column:
    """The buckets of all n-grams of one part. Its letters are bound once, so a long part takes time in proportion."""
    letters = F.concat(F.array(F.lit("^")), F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.array(F.lit("$")))
    return F.get(F.transform(F.array(letters), lambda own: F.concat(*[grams(part, own, n) for n in GRAMS])), F.lit(0))


def buckets(host: Column, path: Column) -> Column:
    """The distinct buckets of the n-grams of both parts, each between end marks."""
    return F.array_distinct(F.concat(part_buckets("h", host), part_buckets("p", path)))


class Model(NamedTuple):
    weights: list[float]
    intercept: float


def numbers(values: list[float]) -> Column:
    """A constant array, short in the plan."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def log_odds(features: Column, model: Model) -> Column:
    weights = numbers(model.weights)
    total = F.aggregate(features, F.lit(0.0), lambda a, i: a + F.element_at(weights, i + 1))
    return F.lit(model.intercept) + total / F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double"))


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", limit: int = LABELLED) -> Model:
    """Gradient steps with a rate of its own for each weight; sums are decimals, so reruns agree. label: 0 or 1."""
    url = F.col(url_col)
    sample = labelled.where(F.col(label_col).isNotNull()).orderBy(F.xxhash64(url), url, label_col).limit(limit)
    rows = cut_lineage(sample.select(buckets(host_of(url), path_of(url)).alias("features"), F.col(label_col).cast("double").alias("label")))
    weights, intercept, squares, square = [0.0] * BUCKETS, 0.0, [1e-8] * BUCKETS, 1e-8
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or positive in (0, n):
        return Model(weights, 30.0 if n and positive else -30.0)
    for _ in range(STEPS):
        error = F.col("label") - 1 / (1 + F.exp(-log_odds(F.col("features"), Model(weights, intercept))))
        scaled = rows.select(error.alias("error"), "features").withColumn("part", F.col("error") / F.sqrt(F.size("features").cast("double")))
        each = scaled.select("part", F.explode(F.concat("features", F.array(F.lit(-1)))).alias("bucket"), "error")
        amount = F.when(F.col("bucket") < 0, F.col("error")).otherwise(F.col("part")).cast("decimal(28,12)")
        for bucket, total in each.groupBy("bucket").agg(F.sum(amount).cast("double")).collect():
            if bucket < 0:
                square += (total / n) ** 2
                intercept += RATE * total / n / math.sqrt(square)
            else:
                slope = total / n - PENALTY * weights[bucket]
                squares[bucket] += slope * slope
                weights[bucket] += RATE * slope / math.sqrt(squares[bucket])
    return Model(weights, intercept)


def judged(df: DataFrame, url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES, model: Model | None = None) -> DataFrame:
    """Adds host, path, rule, verdict and block_probability (null where a rule decides); columns of those names are replaced.

    Without a model, one is trained on the URLs that the rules judge.
    """
    url = F.col(url_col)
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    if model is None:
        labelled = df.select(url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("rule", rule).where("rule IS NOT NULL")
        model = fit(labelled.select("url", (F.col("rule.action") == "block").cast("int").alias("label")))
    parts = df.withColumns({"host": host_of(url), "path": path_of(url)}).withColumn("rule", rule)
    odds = F.when(F.col("rule").isNull(), log_odds(buckets(F.col("host"), F.col("path")), model))
    scored = parts.withColumn("block_probability", 1 / (1 + F.exp(-odds)))
    verdict = F.coalesce(F.col("rule.action"), F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).withColumn("rule", F.col("rule.rule"))


def url_report(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict and block_probability of every row."""
    return judged(pages.select(id_col, url_col), url_col).select(id_col, "host", "path", "rule", "verdict", "block_probability")
