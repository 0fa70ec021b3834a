"""Byte-level BPE by a monoid tree: halves are encoded on their own and joined at their boundary.

An encoding of a text is an element (text, token ids); ``join`` is the associative operation. Joining
re-encodes a window around the boundary and widens it until the tokens outside are proven to stay:

* inside one pre-token, a token sequence is the BPE encoding exactly if each two neighbours encode to
  themselves when joined, so it is enough that the pairs at both edges of the window pass that test;
* between pre-tokens, a cut before a blank or line feed that follows a letter, digit or ASCII mark is
  always a pre-token boundary (no alternative of the pattern takes white space after another
  character, none looks back), so a window from such a cut to such a cut leaves the rest as it is.

Null texts count as empty and have no ids; texts of any length are cut into blocks, never shortened.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_RANKS = "byte_bpe_50k.tiktoken"
#: Longest text, in characters, and longest pre-token, in bytes, that are encoded without halving.
TEXT_BLOCK, PIECE_BLOCK = 8192, 64
#: Pre-tokens whose encodings a worker remembers at least, once it has met so many; twice as many at most.
REMEMBERED = 180_000
SAFE_CUT = regex.compile(r"(?<=[\p{L}\p{N}!-/:-@\[-`{-~])[ \n]")


class Memory(dict):
    """What ``make`` gives for a key; when so many keys are held they grow old, and old ones not asked for again go."""

    def __init__(self, make: Callable[[str], tuple[int, ...]], most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ranks of one vocabulary and the tree that encodes with them."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.no_rank = max(self.bytes_of, default=0) + 1
        self.split = regex.compile(pattern).findall
        self.piece_ids = Memory(self._piece_ids, REMEMBERED)

    def merge(self, piece: bytes) -> list[bytes]:
        """Merges the neighbours of lowest rank, the leftmost first, until no pair is in the vocabulary."""
        if len(piece) > 64:
            return self._merge_long([piece[i : i + 1] for i in range(len(piece))])
        rank, none = self.ranks.get, self.no_rank
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            at = pairs.index(least)
            whole = parts[at] = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(whole + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + whole, none)
        return parts

    def _merge_long(self, parts: list[bytes]) -> list[bytes]:
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live: list[bytes | None] = list(parts)
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i]
            if live[i] is None or j >= n or live[i] + live[j] != whole:
                continue
            live[i], live[j], after[i] = whole, None, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(whole + live[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, whole + live[after[i]]))
            if before[i] >= 0:
                pair = live[before[i]] + whole
                if (r := ranks.get(pair)) is not None:
                    heapq.heappush(heap, (r, before[i], pair))
        return [x for x in live if x is not None]

    def _stays(self, a: bytes, b: bytes) -> bool:
        return self.merge(a + b) == [a, b]

    def join_tokens(self, a: list[bytes], b: list[bytes]) -> list[bytes]:
        """The encoding of the joined bytes of two encodings, both inside one pre-token."""
        if not a or not b:
            return a or b
        width = 1
        while True:
            i, j = min(width, len(a)), min(width, len(b))
            window = self.merge(b"".join(a[len(a) - i :] + b[:j]))
            left, right = a[: len(a) - i], b[j:]
            if (not left or self._stays(left[-1], window[0])) and (not right or self._stays(window[-1], right[0])):
                return left + window + right
            width *= 2

    def tokens(self, piece: bytes) -> list[bytes]:
        if piece in self.ranks:
            return [piece]
        if len(piece) <= PIECE_BLOCK:
            return self.merge(piece)
        middle = len(piece) // 2
        return self.join_tokens(self.tokens(piece[:middle]), self.tokens(piece[middle:]))

    def _piece_ids(self, piece: str) -> tuple[int, ...]:
        return tuple(self.ranks[t] for t in self.tokens(piece.encode("utf-8")))

    def block_ids(self, text: str) -> list[int]:
        pieces = self.split(text)
        if max(map(len, pieces), default=0) <= 256:
            return list(chain.from_iterable(map(self.piece_ids.__getitem__, pieces)))
        return list(chain.from_iterable(self.piece_ids[x] if len(x) <= 256 else self._piece_ids(x) for x in pieces))

    def join_texts(self, a: str, ids_a: list[int], b: str, ids_b: list[int]) -> list[int]:
        """The ids of a + b from those of a and b."""
        width = 64
        while True:
            cuts = [m.start() for m in SAFE_CUT.finditer(a, max(0, len(a) - width))]
            start = cuts[-1] if cuts else 0 if width >= len(a) else None
            cut = SAFE_CUT.search(b, 0, min(len(b), width))
            end = cut.start() if cut else len(b) if width >= len(b) else None
            if start is not None and end is not None:
                break
            width *= 2
        tail, head = len(a[start:].encode("utf-8")), len(b[:end].encode("utf-8"))
        i, j = len(ids_a), 0
        while tail > 0:
            i -= 1
            tail -= len(self.bytes_of[ids_a[i]])
        while head > 0:
            head -= len(self.bytes_of[ids_b[j]])
            j += 1
        return ids_a[:i] + self.block_ids(a[start:] + b[:end]) + ids_b[j:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= TEXT_BLOCK:
            return self.block_ids(text)
        middle = len(text) // 2
        a, b = text[:middle], text[middle:]
        return self.join_texts(a, self.encode(a), b, self.encode(b))

    def decode(self, ids: np.ndarray) -> bytes:
        """Concatenates up the tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def encoder(ranks_path: str) -> Encoder:
    """One per worker process, which Spark keeps for many tasks."""
    return Encoder(ranks_path)


def bpe_ids(text: Column, ranks_path: str | None = None) -> Column:
    """Token ids of a text column as array<int>; null counts as empty."""
    path = ranks_path or public_tokenizers.path(DEFAULT_RANKS)

    @F.pandas_udf("array<int>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for batch in texts:
            yield pd.Series([np.array(enc.encode(x or ""), dtype=np.int32) for x in batch], dtype=object)

    return encode(text)


def bpe_bytes(ids: Column, ranks_path: str | None = None) -> Column:
    """The bytes that an array of token ids stands for; null counts as empty, an unknown id fails."""
    path = ranks_path or public_tokenizers.path(DEFAULT_RANKS)

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for batch in batches:
            yield pd.Series([enc.decode(np.asarray(x if x is not None else [], dtype=np.int64)) for x in batch], dtype=object)

    return decode(ids)


def bpe_round_trip(text: Column, ranks_path: str | None = None) -> Column:
    """struct<token_ids: array<int>, decoded: binary>: both directions in one worker, which then holds one vocabulary."""
    path = ranks_path or public_tokenizers.path(DEFAULT_RANKS)

    @F.pandas_udf("token_ids array<int>, decoded binary")
    def there_and_back(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in texts:
            ids = [np.array(enc.encode(x or ""), dtype=np.int32) for x in batch]
            yield pd.DataFrame({"token_ids": pd.Series(ids, dtype=object), "decoded": pd.Series([enc.decode(x) for x in ids], dtype=object)})

    return there_and_back(text)


def encode_documents(df: DataFrame, text_col: str = "text", ids_col: str = "token_ids", ranks_path: str | None = None) -> DataFrame:
    """Adds the token ids of each text; a column of that name is replaced, all rows and other columns stay."""
    return df.withColumn(ids_col, bpe_ids(F.col(text_col), ranks_path))


def decode_documents(df: DataFrame, ids_col: str = "token_ids", bytes_col: str = "decoded", ranks_path: str | None = None) -> DataFrame:
    """Adds the bytes of each id array; a column of that name is replaced."""
    return df.withColumn(bytes_col, bpe_bytes(F.col(ids_col), ranks_path))


def encoding_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again."""
    coded = df.select(id_col, bpe_round_trip(F.col(text_col), ranks_path).alias("coded")).select(id_col, "coded.*")
    return coded.select(
        id_col,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
