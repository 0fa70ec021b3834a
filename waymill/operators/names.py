"""Names alike by the best window: partial ratios of tokens, found by parts and measured by bit-parallel common subsequences.

The ratio of a token and a name is that of the shorter text s and the window w of the longer one that fits it best:
``200 * lcs(s, w) / (len(s) + len(w))``, windows being as long as s or cut off by an end. Names are brought to
lower case, everything but letters and digits made a blank, their words sorted.

If a ratio is over the cutoff, so many letters of s are in their place in w that of some parts of s one stands there
unchanged. So tokens and names meet by parts, each different text once; which parts, follows from lengths alone, and no pair
is lost. Pairs that meet are measured in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from waymill.operators.common import materialised

#: Pairs measured in one step.
STEP = 1 << 14


def processed(text: Column) -> Column:
    """Lower case, letters and digits only, words sorted and joined by blanks."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"(?U)\W", " ")), r"\s+")
    return F.array_join(F.array_sort(words), " ")


def subsequences(short: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of texts of at most 64 letters with the first 1, 2, ... letters of the windows.

    A bit for each letter of the short text; one addition a letter of the window moves all of them.
    """
    size = short.shape[1]
    ones = np.uint64((1 << size) - 1)
    weights = np.left_shift(np.uint64(1), np.arange(size, dtype=np.uint64))
    state = np.full(len(short), ones)
    out = np.zeros(windows.shape, dtype=np.int64)
    for k in range(windows.shape[1]):
        met = state & ((short == windows[:, k : k + 1]) * weights).sum(axis=1, dtype=np.uint64)
        state = (state + met) | (state - met)
        out[:, k] = size - np.bitwise_count(state & ones)
    return out


def _letters(texts: list[str], size: int) -> np.ndarray:
    return np.array(texts, dtype=f"U{size}").view(np.uint32).reshape(len(texts), size)


def _best(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Best ratios of texts of one length with windows of texts of one length, which is not less."""
    m, n = short.shape[1], long.shape[1]
    sizes = np.arange(1, m + 1)
    best = (2 * subsequences(short, long[:, :m]) / (m + sizes)).max(axis=1)  # windows from the start on
    np.maximum(best, (2 * subsequences(short[:, ::-1], long[:, : n - m - 1 if n > m else None : -1]) / (m + sizes)).max(axis=1), out=best)  # up to the end
    for at in range(1, n - m):
        np.maximum(best, subsequences(short, long[:, at : at + m])[:, -1] / m, out=best)
    return 100 * best


def _plain(short: str, long: str) -> float:
    """The same for texts of over 64 letters, by whole numbers of any size."""
    m, best, ones, place = len(short), 0.0, (1 << len(short)) - 1, {}
    for k, c in enumerate(short):
        place[c] = place.get(c, 0) | 1 << k
    for at in range(1 - m, len(long)):
        window, state = long[max(at, 0) : at + m], ones
        for c in window:
            met = state & place.get(c, 0)
            state = (state + met) | (state - met)
        best = max(best, 2 * (m - (state & ones).bit_count()) / (m + len(window)))
    return 100 * best


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Of each pair; 0 where one text is empty."""
    out = np.zeros(len(a))
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    keys = np.array([(len(x), len(y)) for x, y in pairs], dtype=np.int64).reshape(-1, 2)
    for m, n in np.unique(keys, axis=0).tolist():
        at = np.flatnonzero((keys[:, 0] == m) & (keys[:, 1] == n))
        for own in np.split(at, range(STEP, len(at), STEP)):
            if not m:
                continue
            if m > 64:
                out[own] = [max(_plain(*pairs[i]), _plain(*pairs[i][::-1]) if m == n else 0) for i in own]
                continue
            short, long = _letters([pairs[i][0] for i in own], m), _letters([pairs[i][1] for i in own], n)
            out[own] = _best(short, long) if m < n else np.maximum(_best(short, long), _best(long, short))
    return out


@F.pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(partial_ratios(a.tolist(), b.tolist()))


@F.pandas_udf(DoubleType())
def mean_ratio(tokens: pd.Series, b: pd.Series) -> pd.Series:
    """Mean over the tokens that have anything in common with the text; null if none has."""
    size = np.array([len(t) for t in tokens])
    flat = [t for own in tokens for t in own]
    scores = partial_ratios(flat, [x for x, n in zip(b, size) for _ in range(n)])
    row = np.repeat(np.arange(len(size)), size)
    held = np.bincount(row[scores > 0], minlength=len(size))
    with np.errstate(invalid="ignore"):
        return pd.Series(np.bincount(row, weights=scores, minlength=len(size)) / held).where(held > 0)


def most_lost(size: int, cutoff: float) -> int:
    """The most insertions and deletions between a text of this length and a window of it over the cutoff."""
    return max((size + w - 2 * common for w in range(1, size + 1) for common in range(1, w + 1) if 200 * common > cutoff * (size + w)), default=0)


def parts_of(text: str, cutoff: float) -> list[str]:
    """Parts of a text of which one is unchanged in any window over the cutoff."""
    count = min(len(text), most_lost(len(text), cutoff) + 1)
    cuts = [len(text) * k // count for k in range(count + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def near_tokens(tokens: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """(t, name, ratio): all pairs of different tokens (t) and names (name) with a ratio over the cutoff."""
    sizes = lambda df, c: {r[0]: r[1] for r in df.groupBy(F.length(c)).count().collect()}  # noqa: E731  as many as there are lengths
    lengths = sorted(sizes(tokens, "t"))
    widths = {len(p) for n in lengths for p in parts_of("x" * n, cutoff)}
    shorter = [n for n in sizes(names, "name") if lengths and n < lengths[-1]]
    widths_of_names = {len(p) for n in shorter for p in parts_of("x" * n, cutoff)}

    @F.pandas_udf(ArrayType(StringType()))
    def parts(text: pd.Series) -> pd.Series:
        return text.map(lambda t: list(dict.fromkeys(parts_of(t, cutoff))))

    def grams(of: set[int]) -> F.udf:
        @F.pandas_udf(ArrayType(StringType()))
        def run(text: pd.Series) -> pd.Series:
            return text.map(lambda t: list({t[k : k + w] for w in of for k in range(len(t) - w + 1)}))

        return run

    own = lambda df, c, use: df.select(c, F.explode(use(F.col(c))).alias("part"))
    met = own(tokens, "t", parts).join(own(names, "name", grams(widths)), "part").where(F.length("t") <= F.length("name"))
    other = own(tokens.where(F.length("t") > (min(shorter) if shorter else 1 << 30)), "t", grams(widths_of_names)).join(own(names.where(F.length("name") < (lengths[-1] if lengths else 0)), "name", parts), "part").where(F.length("t") > F.length("name"))
    pairs = met.select("t", "name").unionByName(other.select("t", "name")).distinct()
    return pairs.withColumn("ratio", partial_ratio("t", "name")).where(F.col("ratio") > cutoff)


def duplicate_names(people: DataFrame, key: str, alternative: str, cutoff: float = 80.0) -> DataFrame:
    """name, other, score: people whose name's tokens are found, on average over the cutoff, in another one's alternative name.

    Each token (of the name as it is, split at blanks) is scored against the whole alternative; those with nothing in
    common don't count. A mean over the cutoff has a token over it, so names meet by these. Rows with equal names are one
    person with several alternatives, of which the best counts. Null or empty names and alternatives match nobody.
    """
    words = F.filter(F.transform(F.split(key, " "), processed), lambda t: t != "")
    own = materialised(people.select(F.col(key).alias("name"), words.alias("tokens"), processed(F.col(alternative)).alias("alternative")).where("name IS NOT NULL").distinct())
    others = own.where("alternative <> ''").select(F.col("name").alias("other"), "alternative").distinct()
    lists = materialised(own.select("tokens").where(F.size("tokens") > 0).distinct().select("tokens", F.explode(F.array_distinct("tokens")).alias("t")))
    near = near_tokens(lists.select("t").distinct(), others.select(F.col("alternative").alias("name")).distinct(), cutoff)
    pairs = lists.join(near.select("t", F.col("name").alias("alternative")), "t").select("tokens", "alternative").distinct()
    alike = pairs.withColumn("score", mean_ratio("tokens", "alternative")).where(F.col("score") > cutoff)
    named = alike.join(own.select("name", "tokens").distinct(), "tokens").join(others, "alternative").where("name <> other")
    return named.groupBy("name", "other").agg(F.max("score").alias("score"))


def duplicate_report(people: DataFrame, key: str, alternative: str, cutoff: float = 80.0) -> DataFrame:
    """name, scores, matched_names: one row for each different name, matches in the order of their names, as texts ("87.5, 90.0" and "A, B")."""
    found = duplicate_names(people, key, alternative, cutoff)
    rows = F.array_sort(F.collect_list(F.struct("other", "score")))
    texts = found.groupBy("name").agg(rows.alias("m"))
    shown = F.array_join(F.transform("m", lambda r: F.format_number(r["score"], 1)), ", ")
    names = people.select(F.col(key).alias("name")).where("name IS NOT NULL").distinct()
    met = names.join(texts, "name", "left")
    return met.select("name", F.coalesce(shown, F.lit("")).alias("scores"), F.coalesce(F.array_join(F.transform("m", lambda r: r["other"]), ", "), F.lit("")).alias("matched_names"))
