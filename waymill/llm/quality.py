"""Quality rules: base counts of each text, and how far its letters and common words lie from its language.

A language's references are taken over all its documents: counts of character classes, and counts of its
most frequent words, of any length and script, with one share for all other words. Classes are Unicode categories,
letters told apart by case and by the part of the code space that they come from. A document is compared with both by
Jensen-Shannon distance (base 2, so from 0 to 1). Short texts scatter widely, so each limit widens with
one over the square root of the word count, and neither is applied under a least number of words, in a
language with too little text, or where the language is null.

Null texts count as empty and fail the base rule; repeated rows are judged one by one; ties among common
words go to the smaller word. Extra columns stay with ``filter_documents``.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymill.llm.common import cut_lineage, fresh
from waymill.llm.wordhash import runs, words_of

#: Words that a text needs; share of repeated words, in percent, that it may have.
MIN_WORDS, MAX_REPEATED = 20, 30
#: Common words of a language.
COMMON = 32
#: Distinct words that a task counts before it passes them on.
HELD = 1 << 18
#: Words that a language needs before its documents are compared.
MIN_LANGUAGE_WORDS = 1000
#: Limits are the first number plus the second over the square root of the number of words.
CLASS_LIMIT, WORD_LIMIT = (0.25, 0.5), (0.30, 1.0)
#: Languages whose references are surely small enough to send to every task.
SMALL = 2000

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
WINDOW = 8
#: Classes: the white space that parts words, then letters by case (small, capital, neither) and part of the code
#: space (ASCII, to the end of Latin, other alphabets, from the ideographs on), then marks, digits, other spaces,
#: punctuation, symbols and what is left.
SPACES = "\t\n\v\f\r "
PARTS = (0x80, 0x250, 0x2E80)
BREAK, LETTER, MARK = 0, 1, 1 + 3 * (len(PARTS) + 1)
OTHERS = {"M": MARK, "N": MARK + 1, "Z": MARK + 2, "P": MARK + 3, "S": MARK + 4, "C": MARK + 5}
CLASSES = MARK + len(OTHERS)


def class_of(char: str) -> int:
    kind = unicodedata.category(char)
    if char in SPACES:
        return BREAK
    if kind[0] != "L":
        return OTHERS[kind[0]]
    case = 0 if kind == "Ll" else 1 if kind in ("Lu", "Lt") else 2
    return LETTER + 3 * sum(ord(char) >= end for end in PARTS) + case


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point, as a table that a worker makes once."""
    return np.array([class_of(chr(c)) for c in range(0x110000)], dtype=np.uint8)


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    return np.bincount(classes()[points], minlength=CLASSES)


def lowered(text: str) -> list[bytes]:
    return text.lower().encode("utf-8").split() if not text.isascii() else text.encode("ascii").lower().split()


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more; windows get exact ranks by doubling their length."""
    if len(words) <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    for step in (1, 2, 4):
        pairs = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        distinct, rank, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(distinct) == len(pairs):
            return 0
    starts = np.flatnonzero(counts[rank] > 1)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def distances(p: list[np.ndarray], q: list[np.ndarray]) -> np.ndarray:
    """Jensen-Shannon distance of histograms, row by row; one of an empty histogram is 0. Shorter rows end in zeros."""
    width = max(map(len, [*p, *q]), default=0)
    rows = [np.zeros((len(x), width)) for x in (p, q)]
    for table, given in zip(rows, (p, q)):
        for k, own in enumerate(given):
            table[k, : len(own)] = own
    sums = [x.sum(axis=1, keepdims=True) for x in rows]
    shares = [x / np.maximum(n, 1) for x, n in zip(rows, sums)]
    middle = (shares[0] + shares[1]) / 2
    gain = [(x * np.log2(np.divide(x, middle, out=np.ones_like(x), where=x > 0))).sum(axis=1) for x in shares]
    known = ((sums[0] > 0) & (sums[1] > 0)).ravel()
    return np.where(known, np.sqrt(np.maximum(0.0, (gain[0] + gain[1]) / 2)), 0.0)


def tallies(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, key, n: words (key "n"), characters of each class ("c0" on) and each word ("w" and the word)."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter[bytes]] = defaultdict(Counter)
        chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(CLASSES, dtype=np.int64))

        def passed() -> pd.DataFrame:
            rows = [(lang, "n", sum(own.values())) for lang, own in words.items()]
            rows += [(lang, f"c{k}", v) for lang, own in chars.items() for k, v in enumerate(own.tolist())]
            rows += [(lang, "w" + w.decode("utf-8"), v) for lang, own in words.items() for w, v in own.items()]
            words.clear()
            chars.clear()
            return pd.DataFrame(rows, columns=["lang", "key", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                words[lang].update(lowered(text))
                chars[lang] += class_counts(text)
            if sum(map(len, words.values())) > HELD:
                yield passed()
        if words:
            yield passed()

    known = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return known.mapInPandas(tally, "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def references(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per language with enough text: ref_lang, common_words, word_counts (the last: all others), class_counts."""
    counts = tallies(df, text_col, lang_col)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    common = (
        counts.where(F.col("key").startswith("w")).withColumn("rank", rank).where(F.col("rank") <= COMMON)
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", F.expr("substring(key, 2)").alias("word"), "n"))).alias("common"))
    )
    of = lambda key: F.max(F.when(F.col("key") == key, F.col("n")))
    totals = (
        counts.where(~F.col("key").startswith("w")).groupBy("lang")
        .agg(of("n").alias("n"), F.array(*[of(f"c{k}") for k in range(CLASSES)]).alias("class_counts"))
        .where(F.col("n") >= MIN_LANGUAGE_WORDS)
    )
    rest = F.col("n") - F.aggregate("common.n", F.lit(0).cast("long"), lambda a, x: a + x)
    return totals.join(common, "lang").select(
        F.col("lang").alias("ref_lang"),
        F.col("common.word").alias("common_words"),
        F.concat("common.n", F.array(rest)).alias("word_counts"),
        "class_counts",
    )


FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double"


def features(text: Column, common_words: Column, word_counts: Column, class_counts_: Column) -> Column:
    """struct of the base counts and both distances (null without a reference)."""

    @F.pandas_udf(FEATURES)
    def measure(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, commons, word_refs, class_refs in batches:
            given = [t or "" for t in texts]
            words, counts = words_of(given)
            windows, at = runs(words, WINDOW), 0
            out, held, mine, chars_of, refs = [], [], [], [], []
            for k, (text, common, n) in enumerate(zip(given, commons, counts.tolist())):
                raw, chars = text.encode("utf-8"), class_counts(text)
                own = windows[at : at + n - WINDOW + 1] if n > WINDOW else windows[:0]
                at += n
                # equal windows have equal hashes: only where some agree can words be repeated
                again = repeated_words(raw.split()) if len(np.unique(own)) < len(own) else 0
                out.append((n, int(chars.sum() - chars[BREAK]), sum(map(raw.count, SYMBOLS)), repeated_lines(raw), again))
                if class_refs[k] is not None:
                    seen = Counter(lowered(text))
                    found = [seen[w.encode("utf-8")] for w in common]
                    held.append(k)
                    mine.append(np.array([*found, n - sum(found)]))
                    chars_of.append(chars)
                    refs.append((np.asarray(class_refs[k]), np.asarray(word_refs[k])))
            frame = pd.DataFrame(out, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
            far, word_far = np.full(len(given), np.nan), np.full(len(given), np.nan)
            far[held], word_far[held] = distances(chars_of, [r[0] for r in refs]), distances(mine, [r[1] for r in refs])
            yield frame.assign(class_distance=pd.Series(far).astype("Float64"), word_distance=pd.Series(word_far).astype("Float64"))

    return measure(text, common_words, word_counts, class_counts_)


def judged(df: DataFrame, text_col: str = "text", lang_col: str = "lang", into: str = "quality") -> DataFrame:
    """Adds a struct column: base counts, distances, base_failed and kept. All rows and columns stay."""
    refs = cut_lineage(references(df, text_col, lang_col))
    names = [fresh(c) for c in refs.columns]
    refs = refs.toDF(*names)
    refs = F.broadcast(refs) if refs.count() <= SMALL else refs
    met = df.join(refs, df[lang_col] == refs[names[0]], "left")
    measured = met.withColumn(into, features(met[text_col], *[met[c] for c in names[1:]]))
    f = lambda name: F.col(f"{into}.{name}")
    limit = lambda pair: F.lit(pair[0]) + F.lit(pair[1]) / F.sqrt(f("n_words"))
    far = F.coalesce((f("class_distance") > limit(CLASS_LIMIT)) | (f("word_distance") > limit(WORD_LIMIT)), F.lit(False))
    failed = (f("n_words") < MIN_WORDS) | (100 * f("n_repeat_words") > MAX_REPEATED * f("n_words"))
    kept = ~failed & ~far
    return measured.withColumn(into, F.col(into).withField("base_failed", failed).withField("kept", kept)).drop(*names)


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id and the flat columns of ``judged``, one row for each input row."""
    return judged(df.select(id_col, text_col, lang_col), text_col, lang_col).select(id_col, "quality.*")


def filter_documents(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that the rules keep, with their own columns only."""
    into = fresh("quality")
    return judged(df, text_col, lang_col, into).where(f"{into}.kept").select(*df.columns)
