"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and ``most`` copies that give each source its target of words, the least
divergent from one copy each is ``min(most, exp(slope * size))``: the dual of that convex problem has one
slope a source, found by Newton's method kept inside a bracket. A rate depends on source and size only, so
the iterations run over counts by source and size, exactly, and every step is a grouping of that table.

Rates become copies in three exact steps: each (source, size) cell takes its rounded number of copies;
what a source then lacks or has too much is settled from its largest sizes down, to half a size each; a cell's copies
are dealt to its documents by the hash of their ids, in salted pieces, so that no hot cell meets in a task.
Sums are decimals or integers, so reruns agree.

Null texts have no words; rows without words get one copy. A null source is a source of its own, last in
order. Rows with equal ids are dealt copies one by one. A source of no words has target zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.llm.common import WORD, cut_lineage, fresh

MOST_COPIES = 3
#: The relative gap to the target at which Newton's steps end; rounding settles the rest. Steps from which the
#: bracket is halved instead, which surely ends; steps at most, beyond which it is an error.
GAP, NEWTON, STEPS = 1e-7, 30, 120
#: Documents that share a salted piece on average in a source that holds all rows.
PIECE = 100_000
#: Sources whose state is surely small enough to send to every task.
SMALL = 10_000
EXACT = "decimal(38,9)"
KEY = ["none", "src"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds weight: the given ones by source in code point order, null last, repeating. One row per source.

    Sources are sorted by ranges, each range counts on from those before it, so no task holds them all.
    """
    part, at, first = fresh("part"), fresh("at"), fresh("first")
    ranges = cut_lineage(sources.repartitionByRange(*KEY).withColumn(part, F.spark_partition_id()))
    sizes = ranges.groupBy(part).agg(F.count("*").alias(at))
    starts = sizes.select(part, (F.sum(at).over(Window.orderBy(part)) - F.col(at)).alias(first))
    placed = ranges.withColumn(at, F.row_number().over(Window.partitionBy(part).orderBy(*KEY)) - 1).join(starts, part)
    return placed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col(at) + F.col(first), F.lit(len(weights))) + 1).cast("int"))).drop(part, at, first)


def capped_shares(sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Adds target: all words shared by weight, at most ``most`` times a source's own; what is over goes to the others.

    Each round shares what the capped sources leave among the others by weight, and caps those whose share is
    over their cap, until none is; sums are of integers and each round is one grouping.
    """
    cap = most * F.col("source_size")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = None, -1
    while True:
        # free words to a unit of weight, as a fraction of integers, so that equal shares compare equal
        full = F.lit(False) if level is None else F.lit(level[0]).cast("decimal(38,0)") * F.col("weight") >= cap.cast("decimal(38,0)") * F.lit(level[1])
        row = sources.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("taken"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weights")).first()
        if row.n == capped or not row.weights:
            share = F.lit(float(total - row.taken)) * F.col("weight") / F.lit(max(1, row.weights))
            return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(share))
        level, capped = (int(total - row.taken), int(row.weights)), row.n


def rate(slope: Column, size: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(slope * size))


def solve(cells: DataFrame, sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Adds slope to the sources (columns none, src, source_size, target): the dual solution.

    cells: none, src, size, n. A slope is null where the target needs every document ``most`` times.
    """
    mean, ratio = F.col("source_size") / F.col("docs"), F.col("target") / F.col("source_size")
    docs = cells.where("size > 0").groupBy(*KEY).agg(F.sum("n").alias("docs"))
    active = sources.join(docs, KEY).where(ratio < most * (1 - 1e-12))
    low, high = F.least(F.lit(0.0), F.log(ratio)), F.when(ratio > 1, F.log(F.lit(float(most)))).otherwise(0.0)
    state = cut_lineage(active.select(*KEY, "source_size", "target", low.alias("low"), high.alias("high"), (F.log(ratio) / mean).alias("slope")))
    small = state.count() <= SMALL
    table = cells.where("size > 0")
    for step in range(STEPS):
        met = table.join(F.broadcast(state) if small else state, KEY)
        words = (F.col("n") * F.col("size") * rate(F.col("slope"), F.col("size"), most)).cast(EXACT)
        free = F.exp(F.col("slope") * F.col("size"))
        steep = F.when(free < most, F.col("n") * F.col("size") * F.col("size") * free).otherwise(0.0).cast(EXACT)
        sums = met.groupBy(*KEY, "source_size", "target", "low", "high", "slope").agg(F.sum(words).cast("double").alias("words"), F.sum(steep).cast("double").alias("steep"))
        over = F.col("words") > F.col("target")
        bounded = sums.withColumn("low", F.when(over, F.col("low")).otherwise(F.col("slope"))).withColumn("high", F.when(over, F.col("slope")).otherwise(F.col("high")))
        newton = F.col("slope") - (F.col("words") - F.col("target")) / F.when(F.col("steep") > 0, F.col("steep"))
        inside = (newton > F.col("low")) & (newton < F.col("high")) & F.lit(step < NEWTON)
        narrow = F.col("high") - F.col("low") <= 1e-15 * F.greatest(F.abs("low"), F.abs("high"))
        done = (F.abs(F.col("words") - F.col("target")) <= GAP * F.col("target")) | narrow
        moved = F.when(done, F.col("slope")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = cut_lineage(bounded.select(*KEY, "source_size", "target", "low", "high", moved.alias("slope"), done.alias("done")))
        if state.where("NOT done").isEmpty():
            break
        state = state.drop("done")
    else:
        raise RuntimeError(f"no solution after {STEPS} steps")
    return sources.join(state.select(*KEY, "slope"), KEY, "left")


def settled(cells: DataFrame, solved: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """cells with rate and whole copies, so that each source's words come as near its target as its sizes allow.

    The sizes of one source are walked in one expression; k distinct sizes take at least k*k/2 words, so
    there are at most the square root of twice the source's words.
    """
    met = cells.join(solved.withColumn("known", F.lit(True)), KEY, "left")
    own = F.when(F.col("size") == 0, 1.0).when(F.col("slope").isNull(), float(most)).otherwise(rate(F.col("slope"), F.col("size"), most))
    rounded = cut_lineage(met.withColumn("rate", own).withColumn("copies", F.floor(F.col("n") * F.col("rate") + 0.5).cast("long")))
    cell = F.struct((-F.col("size")).alias("minus"), F.col("size").alias("size"), F.col("n").alias("n"), F.col("copies").alias("copies"))
    lists = rounded.where("size > 0").groupBy(*KEY, "target").agg(F.array_sort(F.collect_list(cell)).alias("cells"), F.sum(F.col("size") * F.col("copies")).alias("taken"))

    def settle(state: Column, c: Column) -> Column:
        more = F.least(F.floor(state["rest"] / c["size"] + 0.5), most * c["n"] - c["copies"])
        less = F.least(F.floor(-state["rest"] / c["size"] + 0.5), c["copies"])
        change = F.when(state["rest"] > 0, F.greatest(more, F.lit(0))).otherwise(-F.greatest(less, F.lit(0))).cast("long")
        fixes = F.when(change == 0, state["fixes"]).otherwise(F.concat(state["fixes"], F.array(F.struct(c["size"].alias("size"), change.alias("change")))))
        return F.struct((state["rest"] - change * c["size"]).alias("rest"), fixes.alias("fixes"))

    start = F.struct((F.col("target") - F.col("taken")).cast("double").alias("rest"), F.array().cast("array<struct<size:bigint,change:bigint>>").alias("fixes"))
    fixes = lists.select(*KEY, F.explode(F.aggregate("cells", start, settle, lambda s: s["fixes"])).alias("fix")).select(*KEY, "fix.size", "fix.change")
    return rounded.join(fixes, [*KEY, "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop("change", "known")


ADDED = ("source_size", "target", "rate", "copies")


def mix(df: DataFrame, id_col: str, size_col: str, key_col: str, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES, names: tuple[str, ...] = ADDED) -> DataFrame:
    """Adds source_size, target, rate and copies to every row of df under the given names; columns of those names are replaced.

    size_col: words of a row, bigint and not null. The table is read twice: to count, and to deal.
    """
    df = df.drop(*[c for c in names if c in df.columns])
    none, src, size, salt, order, least, extra = (fresh(x) for x in ("none", "src", "size", "salt", "order", "least", "extra"))
    salts = max(16, df.count() // PIECE)
    keyed = df.withColumns({none: F.col(key_col).isNull(), src: F.coalesce(F.col(key_col).cast("string"), F.lit("")), size: F.col(size_col), order: F.xxhash64(F.col(id_col).cast("string"), F.lit(7))})
    keyed = keyed.withColumn(salt, F.pmod(order, F.lit(salts)).cast("int"))
    pieces = cut_lineage(keyed.groupBy(F.col(none).alias("none"), F.col(src).alias("src"), F.col(size).alias("size"), F.col(salt).alias("salt")).agg(F.count("*").alias("in_piece")))
    cells = cut_lineage(pieces.groupBy(*KEY, "size").agg(F.sum("in_piece").alias("n")))
    sources = cells.groupBy(*KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    solved = cut_lineage(solve(cells, cut_lineage(capped_shares(cut_lineage(cyclic_weights(sources, weights)), most).drop("weight")), most))
    dealt = pieces.join(settled(cells, solved, most), [*KEY, "size"])
    before = F.coalesce(F.sum("in_piece").over(Window.partitionBy(*KEY, "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = lambda upto: F.expr("copies % n").cast("decimal(19,0)") * upto.cast("decimal(19,0)") / F.col("n")
    dealt = dealt.withColumn("before", before).select(
        F.col("none").alias(none), F.col("src").alias(src), F.col("size").alias(size), F.col("salt").alias(salt), *[F.col(c).alias(name) for c, name in zip(ADDED[:3], names)],
        F.floor(F.col("copies") / F.col("n")).cast("long").alias(least), (F.floor(share(F.col("before") + F.col("in_piece"))) - F.floor(share(F.col("before")))).cast("long").alias(extra),
    )
    ranked = F.row_number().over(Window.partitionBy(none, src, size, salt).orderBy(order, id_col))
    out = keyed.join(dealt, [none, src, size, salt]).withColumn(names[3], F.col(least) + (ranked <= F.col(extra)).cast("long"))
    return out.drop(none, src, size, salt, order, least, extra)


def mix_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str = "source") -> DataFrame:
    """id, size, source_size, target, taken, rate and copies of every row."""
    sized = cut_lineage(df.select(F.col(id_col).alias("id"), F.col(key_col).alias("key"), n_words(F.col(text_col)).alias("size")))
    mixed = mix(sized, "id", "size", "key")
    return mixed.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str = "source") -> DataFrame:
    """The rows of df, each as many times as the mix takes it."""
    size, names = fresh("size"), tuple(fresh(c) for c in ADDED)
    mixed = mix(df.withColumn(size, n_words(F.col(text_col))), id_col, size, key_col, names=names)
    copies = F.col(names[3])
    return mixed.where(copies > 0).withColumn(fresh("again"), F.explode(F.sequence(F.lit(1), copies.cast("int")))).select(*df.columns)
