"""64-bit hashes of words and of runs of words, for many texts at once.

A word is read in parts of eight bytes; each part is mixed into the hash of the parts before it, which is not linear in
its bytes: no pair of unlike words has equal hashes by construction, whatever their length. All words of a step go
through the same parts together; the few words of over ``LONG`` bytes are hashed one by one by XXH64.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes that are hashed in one step, so that memory doesn't grow with a text.
STEP = 1 << 20
ODD, _FULL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes of a word up to which it is hashed with all others.
LONG = 256
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words of some bytes, and their hashes."""
    edges = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    size = ends - starts
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    parts = np.ndarray(len(raw) + 1, dtype="<u8", buffer=padded, strides=(1,))
    out = mixed(size.astype(np.uint64) * ODD)
    who, at = np.flatnonzero(size <= LONG), 0
    while len(who):
        left = np.minimum(size[who] - at, 8).astype(np.uint64)
        part = parts[starts[who] + at] & _FULL >> (np.uint64(64) - left * np.uint64(8))
        out[who] = mixed((out[who] ^ part) * ODD + np.uint64(1))
        at += 8
        who = who[size[who] > at]
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = xxhash.xxh64_intdigest(raw[starts[k] : ends[k]].tobytes(), seed=42)
    return starts, mixed(out)


def words_of(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and how many words each text has."""
    raws = [(t or "").encode("utf-8") for t in texts]
    sizes = np.array([len(r) + 1 for r in raws], dtype=np.int64)
    limits = np.cumsum(sizes)
    whole = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    if lower:
        whole = _LOWER[whole]
    counts, hashes, at = np.zeros(len(raws), dtype=np.int64), [np.zeros(0, dtype=np.uint64)], 0
    while at < len(whole):
        end = min(at + STEP, len(whole))
        if end < len(whole):  # back to the last white space, or on to the next one
            last = np.flatnonzero(_SPACE[whole[at:end]])
            end = at + int(last[-1]) + 1 if len(last) else end + int(np.argmax(_SPACE[whole[end:]])) + 1
        starts, own = _hashes(whole[at:end])
        hashes.append(own)
        counts += np.bincount(np.searchsorted(limits, starts + at, side="right"), minlength=len(raws))[: len(raws)]
        at = end
    return np.concatenate(hashes), counts


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, one for each start."""
    count = max(0, len(words) - length + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(length):
        total += words[k : k + count] * np.uint64(pow(int(ODD), k, 1 << 64))
    return mixed(total)
