"""Names alike by the edit distances of their tokens, without a pair lost and without all pairs in one key.

Rows with the same tokens are one set, whose ids lie in chunks. Tokens near each other are found by parts, where few tokens
share these; tokens whose parts are common (serial numbers) are compared in blocks of neighbours in their order, where
groups of one prefix leave out groups whose prefix is too far. Pairs of sets become rows only at the end, from two chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.operators.common import materialised

#: Ids in a chunk, tokens in a block, tokens in a group of one prefix (on average).
CHUNK, BLOCK, GROUP = 1024, 2048, 16
#: Parts are used for two lengths if they let less than one in so many pairs meet.
SPARSE = 50
#: A pair of names is looked for by so few of its tokens that these must score at most this much less than the threshold.
SLACK = 16
#: Parts of a token's sets, and other tokens of a name that are looked at before a pair is scored.
PARTS, LOOKED = 16, 3
#: Pairs that one task makes at the end, and ids of each side whose pairs it makes at a time.
STEP, SLICE = 32_000_000, 64


def most_edits(length: int, threshold: float) -> int:
    """The most edits that keep a token's score over the threshold, the longer of both tokens having this length; -1 if none do."""
    k = length
    while k >= 0 and 100 * (1 - k / max(length, 1)) <= threshold - 1e-6:
        k -= 1
    return k


def segments(length: int, count: int) -> list[tuple[int, int]]:
    """Start and size of the parts of a token; some are empty where it is shorter than their count."""
    cuts = [length * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows in an order, with their place in a partition and the partition as one number, written down."""
    return materialised(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))


def met_by_parts(tokens: DataFrame, edits: dict[tuple[int, int], int]) -> tuple[DataFrame, DataFrame]:
    """Keys of tokens (e, t, wanted) as the shorter and as the longer one of a pair.

    Of two tokens at most k edits apart, one of k + 1 parts of the shorter one stands in the longer one, moved
    by k places at most; k follows from the longer one's length. So they meet by lengths, part and letters.
    """

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(e, w, m, n, i, t[at : at + size]) for e, t, w in zip(batch["e"], batch["t"], batch["wanted"]) for (m, n), k in edits.items() if n == len(t) for i, (at, size) in enumerate(segments(n, k + 1))]
            yield pd.DataFrame(out, columns=["e", "wanted", "longer", "shorter", "part", "letters"])

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = set()
            for e, t, w in zip(batch["e"], batch["t"], batch["wanted"]):
                for (m, n), k in edits.items():
                    for i, (at, size) in enumerate(segments(n, k + 1) if m == len(t) else []):
                        out |= {(e, w, m, n, i, t[x : x + size]) for x in range(max(0, at - k), min(at + k, m - size) + 1)}
            yield pd.DataFrame(list(out), columns=["e", "wanted", "longer", "shorter", "part", "letters"])

    schema = "e long, wanted boolean, longer int, shorter int, part int, letters string"
    own = tokens.select("e", "t", "wanted")
    return own.mapInPandas(parts, schema), own.mapInPandas(places, schema)


KEY = ["longer", "shorter", "part", "letters"]


def crowded(tokens: DataFrame, edits: dict[tuple[int, int], int], sizes: dict[int, int]) -> set[tuple[int, int]]:
    """The pairs of lengths whose tokens would meet too often by parts."""
    # one number a key: how many of its tokens are wanted, and how many there are
    short, long = ((df.groupBy(*KEY).agg(F.count(F.lit(1)).alias(f"all_{x}"), F.count_if("wanted").alias(f"some_{x}"))) for df, x in zip(met_by_parts(tokens, edits), "sl"))
    pairs = F.col("some_s").cast("double") * F.col("all_l") + (F.col("all_s") - F.col("some_s")).cast("double") * F.col("some_l")
    met = short.join(long, KEY).groupBy("longer", "shorter").agg(F.sum(pairs).alias("n")).collect()  # one row for two lengths
    return {(r[0], r[1]) for r in met if r[2] * SPARSE > sizes[r[0]] * sizes[r[1]]}


def in_blocks(tokens: DataFrame, edits: dict[tuple[int, int], int]) -> DataFrame:
    """x, y (rows of tokens), edits: pairs, each once, at most as many edits apart as their lengths allow.

    Beginnings of equal length of two tokens at most k edits apart are themselves at most k edits apart, and the
    difference of lengths more: what moves places before the cut moves back after it, or is that difference.
    """
    spark = tokens.sparkSession
    columns = tokens.columns
    lengths = sorted({n for pair in edits for n in pair})
    own = tokens.withColumn("n", F.length("t")).where(F.col("n").isin(lengths))
    begun = own.select("n", F.explode(F.sequence(F.lit(0), "n")).alias("d"), "t").select("n", "d", F.substring("t", F.lit(1), F.col("d")).alias("p"))
    # as many rows as lengths and depths
    counts = begun.groupBy("n", "d", "p").agg(F.count(F.lit(1)).alias("c")).groupBy("n", "d").agg(F.sum("c").alias("rows"), F.count(F.lit(1)).alias("groups")).collect()
    depth = {n: min((r["d"] for r in counts if r["n"] == n and r["rows"] <= GROUP * r["groups"]), default=n) for n in lengths}
    depths = spark.createDataFrame(list(depth.items()), "n int, depth int")
    placed = numbered(own.join(F.broadcast(depths), "n"), "place", "n", "t", "e").withColumn("block", F.floor(F.col("place") / BLOCK))
    groups = placed.groupBy("n", "block", F.substring("t", F.lit(1), F.col("depth")).alias("begin")).agg(F.collect_list(F.struct(*columns)).alias("rows"))
    blocks = groups.groupBy("n", "block").agg(F.collect_list(F.struct("begin", "rows")).alias("groups"))
    blocks = materialised(blocks.withColumn("number", F.monotonically_increasing_id()))
    ends = F.struct(F.array_min("groups.begin").alias("low"), F.array_max("groups.begin").alias("high"))
    shared = F.expr("array_max(filter(sequence(0, length(ends.low)), i -> left(ends.low, i) = left(ends.high, i)))")
    heads = blocks.select("number", "n", ends.alias("ends"), F.exists(F.flatten("groups.rows"), lambda r: r["wanted"]).alias("wanted")).withColumn("begin", F.substring("ends.low", F.lit(1), shared))
    heads = materialised(heads.drop("ends"))
    both = [(m, n, k) for (m, n), k in edits.items()]
    both += [(n, m, k) for m, n, k in both if m != n]
    rules = F.broadcast(spark.createDataFrame(both, "n_x int, n_y int, k int").withColumn("slack", F.expr("k + abs(n_x - n_y)")))
    a, b = (heads.select(*[F.col(c).alias(f"{c}_{x}") for c in heads.columns]) for x in "xy")
    close = lambda p, q: F.expr(f"levenshtein(left({p}, length({q})), left({q}, length({p})), slack) >= 0")
    # letters that all tokens of both blocks begin with are left out: they change no distance
    lead = F.expr("array_max(filter(sequence(0, least(length(begin_x), length(begin_y))), i -> left(begin_x, i) = left(begin_y, i)))")
    pairs = a.join(rules, "n_x").join(b, "n_y").where((F.col("number_x") <= F.col("number_y")) & (F.col("wanted_x") | F.col("wanted_y")) & close("begin_x", "begin_y"))
    pairs = materialised(pairs.select("number_x", "number_y", "k", "slack", lead.alias("lead")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs.count() // 2)
    x, y = (blocks.select(F.col("number").alias(f"number_{s}"), F.col("groups").alias(f"groups_{s}")) for s in "xy")
    met = pairs.join(x, "number_x").join(y, "number_y").repartition(min(tasks, 20_000))
    rest = lambda t: F.substring(t, F.col("lead") + 1, F.length(t))
    cut = lambda c: F.transform(c, lambda g: F.struct(rest(g["begin"]).alias("begin"), F.transform(g["rows"], lambda r: F.struct(rest(r["t"]).alias("rest"), r.alias("row"))).alias("rows")))
    same = F.col("number_x") == F.col("number_y")
    met = met.select(same.alias("same"), "k", "slack", cut("groups_y").alias("ys"), F.explode(cut("groups_x")).alias("gx")).select("same", "k", "slack", "gx", F.explode("ys").alias("gy"))
    met = met.where(close("gx.begin", "gy.begin")).select("same", "k", F.col("gy.rows").alias("ys"), F.explode("gx.rows").alias("x")).select("same", "k", "x", F.explode("ys").alias("y"))
    met = met.where((~F.col("same") | (F.col("x.row.e") <= F.col("y.row.e"))) & (F.col("x.row.wanted") | F.col("y.row.wanted"))).where(F.expr("levenshtein(x.rest, y.rest, k) >= 0"))
    return met.select(F.col("x.row").alias("x"), F.col("y.row").alias("y"), F.levenshtein("x.rest", "y.rest").alias("edits"))


def near_tokens(tokens: DataFrame, threshold: float) -> DataFrame:
    """x, y, ratio: each pair of rows of tokens (e, t, wanted and more) once, and each row with itself, if the tokens' score is over the threshold and one is wanted."""
    sizes = {r[0]: r[1] for r in tokens.groupBy(F.length("t")).count().collect()}
    edits = {(m, n): k for m in sizes for n in sizes if n <= m <= n + (k := most_edits(m, threshold))}
    dense = crowded(tokens, edits, sizes) if edits else set()
    # a length shared by parts and blocks is right in both, as each pair of lengths is settled by one of them
    sparse = {pair: k for pair, k in edits.items() if pair not in dense}
    rows = F.struct(*tokens.columns)
    short, long = (df.select(F.col("e").alias(f"e_{x}"), F.col("wanted").alias(f"wanted_{x}"), *KEY) for df, x in zip(met_by_parts(tokens, sparse), "sl"))
    met = short.where("wanted_s").join(long, KEY).unionByName(short.where("NOT wanted_s").join(long.where("wanted_l"), KEY))
    met = met.select(F.least("e_s", "e_l").alias("e_x"), F.greatest("e_s", "e_l").alias("e_y")).distinct()
    out = met.join(tokens.select(F.col("e").alias("e_x"), rows.alias("x")), "e_x").join(tokens.select(F.col("e").alias("e_y"), rows.alias("y")), "e_y").select("x", "y", F.levenshtein("x.t", "y.t").alias("edits"))
    if dense:
        out = out.unionByName(in_blocks(tokens, {pair: edits[pair] for pair in dense}))
    return out.select("x", "y", score(F.col("edits"), F.length("x.t"), F.length("y.t")).alias("ratio")).where(F.col("ratio") > threshold - 1e-6)


def score(edits: Column, m: Column, n: Column) -> Column:
    return 100 * (1 - edits / F.greatest(m, n, F.lit(1)))


def ratio(s: Column, t: Column) -> Column:
    return score(F.levenshtein(s, t), F.length(s), F.length(t))


def mean_ratio(u: Column, v: Column) -> Column:
    """The mean score of the tokens of u, each with the best of v."""
    best = F.transform(u, lambda s: F.array_max(F.transform(v, lambda t: ratio(s, t))))
    return F.round(F.aggregate(best, F.lit(0.0), lambda x, y: x + y) / F.size(u), 6)


def alike_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """k_u, k_v, forth, back: pairs of sets (k, tokens, n) of which one at least has several tokens; each pair once, u having no more tokens.

    If the mean of n tokens is over the threshold, so is that of any j of them over a lower one: 100 less n / j times what the
    threshold lacks. So the j tokens are taken that meet fewest sets. A score is that of u first (forth) or v first (back).
    """
    held = materialised(sets.select("k", "n", F.explode("tokens").alias("t")))
    lack = 100 - threshold + 1e-6
    count = lambda n: max(1, math.ceil(n * lack / (lack + SLACK)))
    present = [r[0] for r in sets.select("n").distinct().collect()]  # as many as there are sizes
    lowest = min((100 - n * lack / count(n) for n in present), default=threshold)
    tokens = materialised(held.groupBy("t").agg(F.max(F.col("n") > 1).alias("wanted")).withColumn("e", F.monotonically_increasing_id()))
    once = materialised(near_tokens(tokens, lowest).select(F.col("x.t").alias("s"), F.col("y.t").alias("t"), "ratio"))
    near = once.unionByName(once.where("s <> t").select(F.col("t").alias("s"), F.col("s").alias("t"), "ratio"))
    df = held.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    reach = near.join(df, "t").groupBy("s").agg(F.sum("df").alias("reach")).withColumnRenamed("s", "t")
    # where one token is enough to ask by, each of the others is near one of the other name too; the first few are looked at
    fits = near.where(F.col("ratio") > lowest - 1e-6).groupBy("s").agg(F.collect_list("t").alias("fits")).withColumnRenamed("s", "t")
    marks = F.struct(F.coalesce("reach", F.lit(0)).alias("reach"), "t", "fits")
    asked = held.join(reach, "t", "left").join(fits, "t", "left").groupBy("k", "n").agg(F.array_sort(F.collect_list(marks)).alias("own"))
    j = F.greatest(F.lit(1), F.ceil(F.col("n") * lack / (lack + SLACK))).cast("int")
    asked = asked.withColumn("j", j).withColumn("least", 100 - F.col("n") * lack / F.col("j"))
    asked = asked.select(F.col("k").alias("k_u"), F.col("n").alias("n_u"), "least", F.when(F.col("j") == 1, F.slice("own.fits", 2, LOOKED)).alias("others"), F.explode(F.slice("own", F.lit(1), F.col("j"))).alias("o")).withColumn("s", F.col("o.t")).drop("o")
    # a token of many sets is dealt to parts: each of those that ask by it goes to all of them
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asks = asked.join(near, "s").where(F.col("ratio") > F.col("least") - 1e-6).select("k_u", "n_u", "others", "t", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    posts = held.join(sets.select("k", "tokens"), "k").where("n > 1").select(F.col("k").alias("k_v"), F.col("n").alias("n_v"), "t", "tokens", F.pmod(F.xxhash64("k"), F.lit(PARTS)).cast("int").alias("part"))
    met = asks.repartition(4 * tasks, "t", "part").hint("merge").join(posts.repartition(4 * tasks, "t", "part"), ["t", "part"]).where("n_u <= n_v")
    for i in range(LOOKED):
        met = met.where((F.coalesce(F.size("others"), F.lit(0)) <= i) | F.arrays_overlap(F.get("others", F.lit(i)), "tokens"))
    turned = (F.col("n_u") == F.col("n_v")) & (F.col("k_u") > F.col("k_v"))
    met = met.select(F.when(turned, F.col("k_v")).otherwise(F.col("k_u")).alias("k_u"), F.when(turned, F.col("k_u")).otherwise(F.col("k_v")).alias("k_v")).distinct()
    u, v = (sets.select(F.col("k").alias(f"k_{x}"), F.col("tokens").alias(x)) for x in "uv")
    scores = F.struct(mean_ratio(F.col("u"), F.col("v")).alias("forth"), F.when(F.size("u") == F.size("v"), mean_ratio(F.col("v"), F.col("u"))).alias("back"))
    # through an array, so that a score is worked out once and not again in the filter
    scored = met.join(u, "k_u").join(v, "k_v").repartition(4 * tasks).select("k_u", "k_v", F.explode(F.array(scores)).alias("s"))
    return scored.select("k_u", "k_v", "s.forth", F.coalesce("s.back", "s.forth").alias("back")).where((F.col("forth") > threshold) | (F.col("back") > threshold))


def sliced(ids: str) -> Column:
    """The ids in slices; few ids are one as they are."""
    cut = F.transform(F.sequence(F.lit(1), F.size(ids), F.lit(SLICE)), lambda i: F.slice(ids, i, F.lit(SLICE)))
    return F.when(F.size(ids) <= SLICE, F.array(ids)).otherwise(cut)


def paired(chunks: DataFrame, threshold: float, most: int = CHUNK) -> DataFrame:
    """id_a < id_b, score of ids_x and ids_y (all pairs, or those of one chunk if it is the same); no set has more than ``most`` ids.

    All pairs of a row are held before the first is handed on, so chunks are cut once more: a task has those of two slices at a time.
    """
    if most > SLICE:
        chunks = chunks.select("same", "forth", "back", "ids_x", F.explode(sliced("ids_y")).alias("ids_y")).select("same", "forth", "back", F.explode(sliced("ids_x")).alias("ids_x"), "ids_y")
    each = chunks.select("same", "forth", "back", "ids_y", F.explode("ids_x").alias("x")).select("same", "forth", "back", "x", F.explode("ids_y").alias("y"))
    each = each.where("CASE WHEN same THEN x < y ELSE x <> y END")
    out = each.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), F.when(F.col("x") < F.col("y"), F.col("forth")).otherwise(F.col("back")).alias("score"))
    return out.where(F.col("score") > threshold)


def similar_names(people: DataFrame, id_col: str, name_col: str, threshold: float = 80.0) -> DataFrame:
    """id_a < id_b, score: pairs of names alike by tokens.

    A token's score is 100 times one minus edit distance over the longer length, to the other name's best
    token; a pair's is the mean over the tokens of the name with fewer (of equals, the first one's). No pair is lost.
    Names of one token meet by their tokens in the job that makes the pairs; the others as sets of tokens first.
    """
    spark = people.sparkSession
    own = people.select(F.col(id_col).alias("id"), F.array_distinct(F.split(F.trim(F.lower(name_col)), r"\s+")).alias("tokens")).where("tokens IS NOT NULL AND id IS NOT NULL")
    own = materialised(own)
    sets = materialised(own.groupBy("tokens").agg(F.count(F.lit(1)).alias("ids")).withColumn("n", F.size("tokens")).withColumn("k", F.monotonically_increasing_id()))
    placed = numbered(own.join(sets.select("tokens", "k", "n"), "tokens").select("k", "n", F.col("tokens")[0].alias("t"), "id"), "place", "k", "id")
    chunks = placed.groupBy("k", F.floor(F.col("place") / CHUNK).alias("chunk")).agg(F.first("n").alias("n"), F.first("t").alias("t"), F.collect_list("id").alias("ids"))
    chunks = materialised(chunks.drop("chunk").withColumn("e", F.monotonically_increasing_id()))

    single = near_tokens(chunks.where("n = 1").select("e", "t", F.lit(True).alias("wanted"), "ids"), threshold)
    rounded = F.round("ratio", 6)
    single = single.select((F.col("x.e") == F.col("y.e")).alias("same"), rounded.alias("forth"), rounded.alias("back"), F.col("x.ids").alias("ids_x"), F.col("y.ids").alias("ids_y"))

    alike = materialised(alike_sets(sets.select("k", "tokens", "n"), threshold))
    most = {r[0]: r[1] for r in sets.groupBy(F.col("n") == 1).agg(F.max("ids")).collect()}  # two rows
    sizes = sets.select("k", "ids")
    made = alike.join(sizes.toDF("k_u", "ids_u"), "k_u").join(sizes.toDF("k_v", "ids_v"), "k_v").agg(F.sum(F.col("ids_u").cast("double") * F.col("ids_v"))).first()[0]
    tasks = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((made or 0) / STEP)), 20_000)
    x, y = (chunks.select(F.col("k").alias(f"k_{s}"), F.col("e").alias(f"e_{c}"), F.col("ids").alias(f"ids_{c}")) for s, c in zip("uv", "xy"))
    several = alike.join(x, "k_u").join(y, "k_v").where("k_u <> k_v OR e_x <= e_y").select((F.col("e_x") == F.col("e_y")).alias("same"), "forth", "back", "ids_x", "ids_y").repartition(tasks)
    # a set of one token meets sets of several too
    return paired(single, threshold, most.get(True, 0)).unionByName(paired(several, threshold, max(most.values(), default=0)))
