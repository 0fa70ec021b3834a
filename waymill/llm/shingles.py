"""SimHash near-duplicates held to a similarity of the sets of word runs: every pair that is alike enough, no other.

A text's set holds the 64-bit hashes of its runs of ``WORDS`` words; a shorter text has one run. Equal sets
share a signature and are one point. ``simhash`` marks each set and its vantage-point trees propose pairs whose
marks lie within a few bits; each is checked by the sets' hashes. Marks alone would lose links: two sets of a
similarity of 0.8 differ in some ten of 64 bits, where chance brings most points of a large corpus together.

So an exact way finds what marks miss. Hashes travel once, to the block of their high bits, where those that
only one row has are dropped: no two sets have them in common. A set goes on only if enough of it is left
to be alike to any other, and what is left of two sets is all that their similarity needs. By one order of
hashes (rare ones first) two sets that are alike share a hash in the part before which too little is left;
sets that share one there are candidates, and each candidate pair is checked by its hashes.

Candidates that marks, or neighbours in the lists, have joined already are not compared again: components stay
the same, and a large group of copies costs no square of its size.

Null and wordless texts have the empty set, linked like any other. Repeated rows and ids are as in ``simhash``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.llm import simhash
from waymill.llm.common import cut_lineage
from waymill.llm.components import stars
from waymill.llm.exchange import by_block, met, pack_counts, pack_keys, spread, unpack_counts, unpack_keys
from waymill.llm.wordhash import ODD, mixed, runs, words_of

#: Words of a run; the least similarity as a fraction, so that limits are exact.
WORDS, ALIKE = 5, (4, 5)
#: Bits within which marks propose a pair.
NEAR = 3
#: Characters of the texts whose hashes travel together; bytes of text whose hashes a block gets.
PIECE, SHARE = 4 << 20, 16 << 20


def shingle_sets(texts: list[str | None], length: int = WORDS) -> list[np.ndarray]:
    """Ascending distinct hashes of the runs of words of each text."""
    words, counts = words_of(texts, lower=True)
    ends = np.cumsum(counts)
    return [np.unique(runs(words[e - c : e], min(length, c))) if c else words[:0] for e, c in zip(ends.tolist(), counts.tolist())]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    sums = np.array([mixed(own ^ ODD).sum(dtype=np.uint64) for own in sets], dtype=np.uint64)
    return mixed(sums ^ np.array([len(own) for own in sets], dtype=np.uint64))


def signed(text: Column) -> Column:
    """struct<fp: bigint, mark: bigint>: one fp for equal sets, and the SimHash fingerprint of the set."""

    @F.pandas_udf("fp long, mark long")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(np.zeros(0, dtype=np.uint64),) * 2]
            for own in pieces(list(batch)):
                sets = shingle_sets(own)
                out.append((signatures(sets), simhash.bit_majority(np.concatenate(sets), [len(s) for s in sets])))
            fps, marks = (np.concatenate(x).view(np.int64) for x in zip(*out))
            yield pd.DataFrame({"fp": fps, "mark": marks})

    return sign(text)


def signature(text: Column) -> Column:
    """One bigint for equal sets."""
    return signed(text)["fp"]


def pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
    own, size = [], 0
    for text in texts:
        if own and (size > PIECE or len(own) == 1 << 16):
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text or "")
    if own:
        yield own


def shared_sets(df: DataFrame, text_col: str, alike: tuple[int, int] = ALIKE, share: int = SHARE) -> DataFrame:
    """fp, n, keys of each different set that may have another alike: its size, and its hashes that other rows have too, rare ones first."""
    part, whole = alike
    texts = df.select(F.col(text_col).alias("text"))
    count = max(1, math.ceil(texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] / share))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = TaskContext.get().partitionId() << 40
        for batch in batches:
            for own in pieces(list(batch["text"])):
                sets = shingle_sets(own)
                sizes = np.array([len(s) for s in sets], dtype="<u4")
                keys, who = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype="<u2"), sizes)
                order = np.argsort(keys, kind="stable")
                keys, who = keys[order], who[order]
                rows = [(piece % count, piece, b"", b"", signatures(sets).tobytes(), sizes.tobytes())]
                rows += [(block, piece, pack_keys(keys[at]), who[at].tobytes(), b"", b"") for block, at in by_block(keys, count)]
                yield pd.DataFrame(rows, columns=["block", "piece", "keys", "who", "fps", "sizes"])
                piece += 1

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_keys(x) for x in group["keys"]]
        distinct, at = met(keys)
        counts = np.bincount(np.concatenate(at), minlength=len(distinct))
        out = []
        for own, place, piece, who, fps, sizes in zip(keys, at, group["piece"], group["who"], group["fps"], group["sizes"]):
            held = counts[place]
            many = held > 1
            if len(fps) or many.any():
                out.append((piece, pack_keys(own[many]), np.frombuffer(who, dtype="<u2")[many].tobytes(), pack_counts(held[many]), fps, sizes))
        return pd.DataFrame(out, columns=["piece", "keys", "who", "held", "fps", "sizes"])

    def gathered(group: pd.DataFrame) -> pd.DataFrame:
        keys, held = (np.concatenate(list(map(f, group[c]))) for f, c in ((unpack_keys, "keys"), (unpack_counts, "held")))
        who, fps, sizes = (np.frombuffer(b"".join(group[c]), dtype=kind) for c, kind in (("who", "<u2"), ("fps", "<i8"), ("sizes", "<u4")))
        sizes = sizes.astype(np.int64)
        order = np.lexsort((keys, held, who))
        keys, bounds = keys[order], np.searchsorted(who[order], np.arange(len(fps) + 1))
        left, at = np.diff(bounds), bounds[:-1]
        fit = np.flatnonzero((sizes > 0) & (whole * left >= part * sizes))
        return pd.DataFrame({"fp": fps[fit], "n": sizes[fit], "keys": [keys[at[i] : at[i] + left[i]].tobytes() for i in fit]})

    asked = spread(texts.mapInPandas(send, "block long, piece long, keys binary, who binary, fps binary, sizes binary"), "block", count)
    answered = spread(asked.groupBy("block").applyInPandas(shared, "piece long, keys binary, who binary, held binary, fps binary, sizes binary"), "piece", count)
    return answered.groupBy("piece").applyInPandas(gathered, "fp long, n long, keys binary").dropDuplicates(["fp"])


def prefixes(sets: DataFrame, alike: tuple[int, int] = ALIKE) -> DataFrame:
    """fp, n, at, first: the hashes of each set of which one must be shared, and the place of the first in the set's order."""
    part, whole = alike

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [np.frombuffer(x, dtype="<i8") for x in batch["keys"]]
            first = [k[: len(k) - -(-part * n // whole) + 1] for k, n in zip(keys, batch["n"])]
            yield pd.DataFrame({"fp": batch["fp"], "n": batch["n"], "at": batch["n"] - [len(k) for k in keys], "first": first})

    return sets.mapInPandas(cut, "fp long, n long, at long, first array<long>")


def lists_of(heads: DataFrame, *columns: str) -> DataFrame:
    """A row for each hash of the prefixes: key, its place, and the named columns."""
    return heads.select(*columns, "at", F.posexplode("first").alias("pos", "key")).withColumn("at", F.col("at") + F.col("pos")).drop("pos")


def checked(pairs: DataFrame, sets: DataFrame, alike: tuple[int, int] = ALIKE) -> DataFrame:
    """Those of the pairs (a, b) that are alike."""
    part, whole = alike

    @F.pandas_udf("long")
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(np.frombuffer(p, dtype="<u8"), np.frombuffer(q, dtype="<u8"), assume_unique=True)) for p, q in zip(x, y)], dtype="int64")

    one, other = (sets.select(F.col("fp").alias(s), F.col("n").alias(f"n_{s}"), F.col("keys").alias(f"keys_{s}")) for s in "ab")
    met = pairs.join(one, "a").join(other, "b").withColumn("common", common("keys_a", "keys_b"))
    return met.where(F.col("common") * (part + whole) >= part * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def proposed(marks: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b) of different fps that connect those whose marks are equal or lie within so many bits."""
    firsts = cut_lineage(marks.groupBy("mark").agg(F.min("fp").alias("first")))
    equal = marks.join(firsts, "mark").where("fp <> first").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    near = simhash.links(firsts.select(F.col("mark").alias("fp")), distance)
    a, b = (firsts.select(F.col("mark").alias(c), F.col("first").alias(f"fp_{c}")) for c in "ab")
    return equal.unionByName(near.join(a, "a").join(b, "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))


def links(df: DataFrame, text_col: str, marks: DataFrame, alike: tuple[int, int] = ALIKE, share: int = SHARE, distance: int = NEAR) -> DataFrame:
    """Edges (a, b) that connect exactly the signatures of sets alike by at least the fraction. marks: fp, mark of each set."""
    part, whole = alike
    sets = cut_lineage(shared_sets(df, text_col, alike, share))
    heads = cut_lineage(prefixes(sets, alike))
    before = Window.partitionBy("key").orderBy("n", "fp")
    follow = lists_of(heads, "fp", "n").select("fp", "n", F.lag("fp").over(before).alias("a"), F.lag("n").over(before).alias("n_a")).where(whole * F.col("n_a") >= part * F.col("n"))
    pairs = proposed(marks, distance).unionByName(follow.select("a", F.col("fp").alias("b")))
    near = cut_lineage(checked(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets, alike))
    roots = stars(near).withColumnsRenamed({"a": "fp", "b": "root"})
    named = cut_lineage(heads.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    return near.unionByName(checked(apart(named, alike), sets, alike))


def apart(named: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of sets of different roots that may be alike: each once, in the list of the first hash that both prefixes have.

    Of two prefixes one ends first in the order of hashes; up to there all common hashes are in both, after it
    come at most the rest of its own set. So hashes common to the prefixes and the larger rest bound the similarity.
    Lists whose sets have one root are closed: sets of different roots have none of their hashes in common. So of a
    prefix only the hashes of open lists go along.
    """
    part, whole = alike
    rows = lists_of(named, "fp", "n", "root")
    open_keys = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    held = cut_lineage(rows.join(open_keys, "key", "left_semi"))
    firsts = held.groupBy("fp").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "key"))), lambda x: x["key"]).alias("first"))
    open_rows = held.join(firsts, "fp")
    a, b = (open_rows.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("fp", "n", "at", "root", "first")]) for s in "ab")
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = lambda most: most * (part + whole) >= part * (F.col("n_a") + F.col("n_b"))
    both = F.array_intersect("first_a", "first_b")
    rest = lambda n: F.ceil(n * part / whole) - 1
    most = F.size(both) + F.greatest(rest(F.col("n_a")), rest(F.col("n_b")))
    cheap = (F.col("root_a") != F.col("root_b")) & (F.col("fp_a") < F.col("fp_b")) & enough(left)
    met = a.join(b, "key").where(F.when(cheap, (F.element_at(both, 1) == F.col("key")) & enough(most)).otherwise(False))
    return met.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))


def marked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", alike: tuple[int, int] = ALIKE, share: int = SHARE, distance: int = NEAR) -> DataFrame:
    """id, fp, root (least fp of the component), component_id (least id), for each row."""
    docs = cut_lineage(df.select(F.col(id_col).alias("id"), signed(F.col(text_col)).alias("own")).select("id", "own.*"))
    marks = docs.select("fp", "mark").distinct()
    return simhash.rooted(docs.drop("mark"), lambda points: links(df, text_col, marks, alike, share, distance))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", alike: tuple[int, int] = ALIKE, share: int = SHARE) -> DataFrame:
    """One row of each component, as ``simhash.keep_first``."""
    return simhash.first_rows(df, marked(df, id_col, text_col, alike, share), signature, id_col, text_col)
