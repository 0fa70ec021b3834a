"""Token counts for a word-end BPE vocabulary with a whole-token shortcut.

Offline, on the driver and once for a vocabulary, every vocabulary string that can be a whole pre-token is
encoded on its own; those that come out as one token form the shortcut table, which goes to the workers. A text
is normalised and cut into pre-tokens; those in the table count one each, only the rest are merged, and a worker
remembers the rest's counts. Long pre-tokens are merged by a heap, in time about proportional to their length.

Null texts count as empty: no bytes, no tokens. Texts are never shortened. A text that holds the string of
a special token is cut there, as the tokenizer does by default: each such string is one token.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 120_000
#: Letters of a pre-token from which a heap is quicker than looking at all pairs.
LONG = 48
END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable in Latin-1, else from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Counter:
    """Merges and special strings of one vocabulary file, and its shortcut table."""

    def __init__(self, path: str, single: frozenset[str] | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.none = len(pairs)
        self.letters = byte_letters()
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.single = self.prove_single(model["vocab"]) if single is None else single
        self.extra = lru_cache(maxsize=REMEMBERED)(self._extra)

    def prove_single(self, vocabulary: dict[str, int]) -> frozenset[str]:
        """Strings that are one pre-token and that the merges turn into one token."""
        byte_of = {c: b for b, c in enumerate(self.letters)}
        found = set()
        for token in vocabulary:
            if not token.endswith(END):
                continue
            try:
                text = bytes(byte_of[c] for c in token.removesuffix(END)).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if self.pieces(text) == [text] and self.merge(text) == [token]:
                found.add(text)
        return frozenset(found)

    def merge(self, piece: str) -> list[str]:
        """The tokens of one pre-token: neighbours of lowest rank merge first, the leftmost of equals."""
        letters, rank, none = self.letters, self.rank.get, self.none
        parts = [letters[b] for b in piece.encode("utf-8")]
        parts[-1] += END
        if len(parts) > LONG:
            return self.merge_long(parts)
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            whole = parts[at] = parts[at] + parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((whole, parts[at + 1]), none)
            if at:
                ranks[at - 1] = rank((parts[at - 1], whole), none)
        return parts

    def merge_long(self, parts: list[str]) -> list[str]:
        """The same by a heap of pairs; a pair whose parts have been merged since is passed over."""
        rank, n = self.rank.get, len(parts)
        live: list[str | None] = list(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if live[i] != left or j >= n or live[j] != right:
                continue
            live[i], live[j], after[i] = left + right, None, after[j]
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n:
                    before[b] = a
                    pair = (live[a], live[b])
                    if (r := rank(pair)) is not None:
                        heapq.heappush(heap, (r, a, pair))
        return [x for x in live if x is not None]

    def _extra(self, piece: str) -> int:
        """Tokens of a pre-token beyond one."""
        return 0 if piece in self.single else len(self.merge(piece)) - 1

    def normal(self, text: str) -> str:
        # letter by letter, so a capital sigma never takes its final form
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def plain(self, text: str) -> int:
        pieces = self.pieces(self.normal(text))
        if max(map(len, pieces), default=0) <= 256:
            return len(pieces) + sum(map(self.extra, pieces))
        return len(pieces) + sum(self.extra(p) if len(p) <= 256 else self._extra(p) for p in pieces)

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))


@lru_cache(maxsize=2)
def proven(path: str) -> frozenset[str]:
    """The shortcut table of a vocabulary."""
    return Counter(path).single


@lru_cache(maxsize=1)
def counter(path: str, table: Broadcast | None = None) -> Counter:
    """One per worker process, which Spark keeps for many tasks; without a table it is proven here."""
    return Counter(path, table.value if table else None)


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    """Tokens of a text column as bigint."""
    path = vocabulary or public_tokenizers.path(DEFAULT_VOCABULARY)
    table = SparkSession.active().sparkContext.broadcast(proven(path))

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path, table)
        for batch in texts:
            yield pd.Series([c.count(x) if x else 0 for x in batch], dtype="int64")

    return count(text)


def token_counts(df: DataFrame, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """id, n_bytes, n_tokens and whether a text is over the limit of tokens, one row for each input row."""
    counted = df.select(
        id_col,
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text_col), vocabulary).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
