"""Pseudonyms and synthetic oversampling, all by hashes of keys and a seed, so that a second run gives the same."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymill.operators.common import bound, fresh, materialised

LETTERS, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def draw(n: Column, *parts: Column, seed: int = 0) -> Column:
    """A whole number from 0 up to n, by hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), n)


def sampled(entities: DataFrame, key: str, size: int, seed: int = 0) -> DataFrame:
    """replica, key: ``size`` draws with replacement from the distinct keys in the order of their hashes.

    Each key takes as many draws as fall to its place. Places come from a range exchange and counts of its
    parts, so no task sorts all keys.
    """
    keys = entities.select(key).dropna().distinct()
    n = keys.count()
    if not n:
        return keys.select(F.lit(0).cast("long").alias("replica"), key)
    draws = entities.sparkSession.range(size).select(F.col("id").alias("replica"), draw(F.lit(n), F.col("id"), seed=seed).alias("place"))
    return draws.join(numbered(keys, key, seed), "place").select("replica", key)


def numbered(keys: DataFrame, key: str, seed: int, parts: int = 4096) -> DataFrame:
    """key, place: 0 up by the hash of the key; first by parts of the hash range, then within each."""
    own = keys.select(key, F.xxhash64(F.lit(seed), key).alias("h")).withColumn("part", F.shiftrightunsigned("h", 52).cast("int"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = own.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("h", key)) - 1
    return own.withColumn("rank", rank).join(F.broadcast(sizes), "part").select(key, (F.col("before") + F.col("rank")).alias("place"))


def replicated(facts: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Facts of each drawn entity, once for each draw."""
    return facts.join(sample, key)


#: Rounds of the permutation.
ROUNDS = 8


def shape_of(c: Column) -> Column:
    """The text with A for each letter and 0 for each digit: texts of one shape are permuted among themselves."""
    return F.regexp_replace(F.regexp_replace(c, "[A-Za-z]", "A"), "[0-9]", "0")


def permuted(c: Column, seed: int) -> Column:
    """Another text of the same shape, no two texts having the same one; null where it has neither letters nor digits.

    A Feistel network over its letters and digits: halves take turns, each character of one is shifted, in its own
    alphabet, by a hash of the other half, the shape, the round and its place. Shifts can be taken back, so the whole is a
    permutation of all texts of a shape, capital letters for all.
    """
    own = F.regexp_replace(c, "[^A-Za-z0-9]", "")

    def shifted(part: Column, other: Column, shape: Column, k: int) -> Column:
        def one(ch: Column, i: Column, joined: Column) -> Column:
            h = F.xxhash64(F.lit(seed), shape, F.lit(k), i, joined)
            at = lambda alphabet: F.substring(F.lit(alphabet), (F.pmod(F.instr(F.lit(alphabet), ch) - 1 + F.pmod(h, F.lit(len(alphabet))), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))
            return F.when(ch.between("0", "9"), at(DIGITS)).otherwise(at(LETTERS))

        return bound(F.array_join(other, ""), lambda joined: F.transform(part, lambda ch, i: one(ch, i, joined)))

    def turn(shape: Column, k: int) -> Callable[[Column], Column]:
        if k % 2:
            return lambda s: F.struct(s["a"].alias("a"), shifted(s["b"], s["a"], shape, k).alias("b"))
        return lambda s: F.struct(shifted(s["a"], s["b"], shape, k).alias("a"), s["b"].alias("b"))

    def walked(x: Column, shape: Column) -> Column:
        size = F.ceil(F.size(x) / 2).cast("int")
        state = F.struct(F.slice(x, F.lit(1), size).alias("a"), F.slice(x, size + 1, F.size(x)).alias("b"))
        for k in range(ROUNDS):
            state = bound(state, turn(shape, k))
        return bound(state, lambda s: F.concat(s["a"], s["b"]))

    def written(new: Column) -> Column:
        """The new letters and digits in the places of the old ones, in one pass."""
        changes = lambda x: x.between("0", "9") | x.between("A", "Z") | x.between("a", "z")
        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

        def add(s: Column, x: Column) -> Column:
            return F.struct((s["at"] + changes(x).cast("int")).alias("at"), F.concat(s["out"], F.when(changes(x), F.get(new, s["at"] - 1)).otherwise(x)).alias("out"))

        return F.aggregate(F.split(c, ""), start, add, lambda s: s["out"])

    return F.when(own != "", bound(shape_of(c), lambda shape: bound(walked(F.split(F.upper(own), ""), shape), written)))


def texts_of(spark: SparkSession, shape: str, name: str) -> DataFrame:
    """All texts of a shape."""
    sizes = [{"A": 26, "0": 10}.get(ch, 1) for ch in shape]
    steps = [math.prod(sizes[k + 1 :]) for k in range(len(shape))]
    one = lambda ch, n, d: F.substring(F.lit(LETTERS if n == 26 else DIGITS), F.expr(f"int(id div {d}L % {n}) + 1"), F.lit(1)) if n > 1 else F.lit(ch)
    return spark.range(math.prod(sizes)).select(F.concat(*[one(ch, n, d) for ch, n, d in zip(shape, sizes, steps)]).alias(name))


def unique_pseudonyms(keys: DataFrame, key: str, taken: DataFrame, seed: int = 0, rounds: int = 64) -> DataFrame:
    """key, alias: an alias of the same shape for each different key, all different, none taken.

    The permutation gives different keys different aliases in one pass. Only those whose alias is taken, and keys equal to
    another but for the case of letters, walk on along the permutation to the next free one. Shapes of which over an eighth
    is in use are dealt exactly instead: all their free texts, as many as keys and taken ones at most eight times, are
    numbered, and so are the keys. Too few free texts are an error, as is a key without letters and digits.
    """
    own = materialised(keys.select(F.col(key).alias("key")).dropna().distinct())
    used = taken.select(F.col(taken.columns[0]).alias("alias")).dropna().distinct()
    count = lambda df, c, name: df.groupBy(shape_of(F.col(c)).alias("shape")).agg(F.count("*").alias(name))
    size = F.pow(F.lit(26.0), F.length(F.regexp_replace("shape", "[^A]", ""))) * F.pow(F.lit(10.0), F.length(F.regexp_replace("shape", "[^0]", "")))
    shapes = count(own, "key", "n").join(count(used, "alias", "m"), "shape", "left").fillna(0, ["m"]).where((F.col("n") + F.col("m")) * 8 > size).orderBy("shape")
    dense = [(r.shape, r.n) for r in shapes.select("shape", "n").collect()]  # the space of each is bounded by its rows
    out = []
    for shape, n in dense:
        if not set(shape) & {"A", "0"}:
            raise ValueError(f"keys like {shape!r} have no letters or digits to change")
        free = materialised(texts_of(own.sparkSession, shape, "alias").join(used, "alias", "left_anti"))
        if free.count() < n:
            raise ValueError(f"fewer free pseudonyms than keys of the shape {shape}")
        places = numbered(own.where(shape_of(F.col("key")) == shape), "key", seed).join(numbered(free, "alias", seed + 1), "place")
        out.append(places.select("key", "alias"))
    left = own.where(~shape_of(F.col("key")).isin([s for s, _ in dense])) if dense else own
    held, walking = materialised(used), left.withColumn("alias", F.col("key"))
    for _ in range(rounds):
        drawn = walking.withColumn("alias", permuted(F.col("alias"), seed))
        first = materialised(drawn.groupBy("alias").agg(F.min("key").alias("key")).join(held, "alias", "left_anti").select("key", "alias"))
        out.append(first)
        walking = materialised(drawn.join(first, "key", "left_anti"))
        if walking.isEmpty():
            return reduce(DataFrame.unionByName, out).withColumnRenamed("key", key)
        held = held.unionByName(first.select("alias"))
    raise ValueError(f"no free pseudonym for some keys after {rounds} steps")


def word_pseudonym(c: Column, words: list[str], seed: int = 0) -> Column:
    """A word of a list, the same for the same value."""
    return F.when(c.isNotNull(), F.element_at(F.array(*map(F.lit, words)), (draw(F.lit(len(words)), c, seed=seed) + 1).cast("int")))


def person_fields(first: Column, last: Column, key: Column, domain: str = "example.com", seed: int = 0) -> dict[str, Column]:
    """An e-mail, a phone and a licence number made from a pseudonym and a key."""
    eight = F.lpad(draw(F.lit(10**8), key, seed=seed).cast("string"), 8, "0")
    return {"email": F.lower(F.concat(first, F.lit("."), last, F.lit(f"@{domain}"))), "phone": F.concat(F.lit("06"), eight), "licence": F.upper(F.substring(F.sha2(key.cast("string").cast("binary"), 256), 1, 12))}


def remapped_keys(facts: DataFrame, mapping: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """A foreign key put over to its new value; one without a new value fails while the job runs."""
    before, after = fresh(facts, "old", "new")
    m = mapping.select(F.col(old).alias(before), F.col(new).alias(after))
    met = facts.join(m, F.col(column) == F.col(before), "left")
    missing = F.raise_error(F.concat(F.lit(f"no parent for {column} "), F.col(column).cast("string")))
    value = F.when(F.col(column).isNull(), None).when(F.col(before).isNull(), missing.cast(dict(mapping.dtypes)[new])).otherwise(F.col(after))
    return met.withColumn(column, value).drop(before, after)


def changed(df: DataFrame, column: str, condition: Column, key: str, factor: tuple[float, float] | None = None, shift: tuple[float, float] | None = None, choices: list[str] | None = None, seed: int = 0) -> DataFrame:
    """A change under a condition: one factor or shift drawn for the rule, or a choice drawn for each row."""
    import random

    if choices:
        new = F.element_at(F.array(*map(F.lit, choices)), (draw(F.lit(len(choices)), F.col(key), seed=seed) + 1).cast("int"))
    else:
        once = random.Random(seed).uniform(*(factor or shift))
        new = F.col(column) * once if factor else F.col(column) + once
    return df.withColumn(column, F.when(condition, new).otherwise(F.col(column)))


def regenerated(key: Column, replica: Column) -> Column:
    """A new unique value for a copy of a row."""
    return F.sha2(F.concat_ws("|", key.cast("string"), replica.cast("string")).cast("binary"), 256)
