"""Duplicate passages by relative Lempel-Ziv parsing of every document against an index of all documents.

The reference is all texts, in pieces, each the words of its texts one after the other. The index has, for each
window of ``length`` consecutive words, the place (piece, word) where it starts in the document of least id. A
document is parsed greedily from left to right: where a window is found in a document of smaller id, a factor
starts there, (piece, place, number of words), and grows as long as the next window is found at the next place of
the same reference; then the next factor starts at the first window found after. The windows across the boundary
of two factors are looked up like all others, so factors overlap there and no covered word is missed.

Then each factor's words are compared with the words at its place in the reference, by a 128-bit digest of their
bytes, in the piece that holds them. Only factors that agree remove words: words are never lost to hashes of
windows, which have 64 bits, that agree by chance.

Windows are not all sent: each window's anchor is the least hash of its ``ANCHOR``-word runs, equal windows have
equal anchors, and only windows whose anchor occurs in more than one piece are asked for; those within a piece are
settled there. Answers come from ``exchange``'s blocks.

Ids are integers. Null texts have no words. A null id is not smaller than any: such rows neither lose words nor
make others lose them. Rows with equal ids don't remove each other's words. Other columns don't matter and are
not kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from waymill.llm.exchange import answer, ask, blocks_for, by_block, in_order, met, pack_flags, pack_ints, pack_keys, packed, receive, spread, unpack, unpack_flags, unpack_ints, unpack_keys
from waymill.llm.wordhash import runs, words_of

LENGTH, ANCHOR, DIGEST = 13, 5, 16
NOBODY = np.iinfo(np.int64).max
NONE = np.zeros(0, dtype=np.int64)


class Windows:
    """Of a piece's texts: for each window inside one text, its start, hash, anchor and owner's id."""

    def __init__(self, rows: pd.DataFrame, length: int = LENGTH):
        words, self.counts = words_of(rows["text"].tolist())
        ids = rows["id"]
        owner = np.repeat(np.arange(len(ids)), self.counts)
        known = ids.notna().to_numpy()
        self.ids = np.where(known, ids.fillna(0).astype("int64").to_numpy(), NOBODY)
        short = min(ANCHOR, length)
        hashes, grams = runs(words, length), runs(words, short)
        least = np.full(len(hashes), np.iinfo(np.uint64).max, dtype=np.uint64)
        for k in range(length - short + 1):
            np.minimum(least, grams[k : k + len(hashes)], out=least)
        inside = (owner[: len(hashes)] == owner[length - 1 :]) & known[owner[: len(hashes)]] if len(hashes) else np.zeros(0, dtype=bool)
        self.start = np.flatnonzero(inside)
        self.hash, self.anchor, self.owner = hashes[inside], least[inside], owner[: len(hashes)][inside]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.anchor, return_inverse=True)

    def index(self, chosen: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the chosen windows, the least id of each, its first place there, and each window's place among them."""
        hashes, ids, starts = self.hash[chosen], self.ids[self.owner[chosen]], self.start[chosen]
        order = np.lexsort((starts, ids, hashes))
        distinct, first, place = np.unique(hashes[order], return_index=True, return_inverse=True)
        back = np.empty(len(order), dtype=np.int64)
        back[order] = place
        return distinct, ids[order][first], starts[order][first], back


def factors(start: np.ndarray, owner: np.ndarray, piece: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """(start, words, piece, place) of the greedy factors of the windows found, given where each one's reference is."""
    if not len(start):
        return np.zeros((0, 4), dtype=np.int64)
    grows = (start[1:] == start[:-1] + 1) & (owner[1:] == owner[:-1]) & (piece[1:] == piece[:-1]) & (place[1:] == place[:-1] + 1)
    begin = np.flatnonzero(np.r_[True, ~grows])
    return np.stack([start[begin], np.diff(np.r_[begin, len(start)]) + length - 1, piece[begin], place[begin]], axis=1)


class Words:
    """Words of single texts of a piece, by their place in the piece."""

    def __init__(self, rows: pd.DataFrame, counts: np.ndarray):
        self.texts, self.ends, self.at, self.words = rows["text"].tolist(), np.cumsum(counts), -1, []

    def digest(self, place: int, count: int) -> bytes:
        """Of so many words from a place on; they lie in one text."""
        text = int(np.searchsorted(self.ends, place, side="right"))
        if text != self.at:
            self.at, self.words = text, (self.texts[text] or "").encode("utf-8").split()
        start = place - (int(self.ends[text - 1]) if text else 0)
        return hashlib.blake2b(b" ".join(self.words[start : start + count]), digest_size=DIGEST).digest()


def found_windows(pieces: DataFrame, count: int, length: int) -> DataFrame:
    """For each piece and block: which of the windows asked for documents of smaller id in other pieces have, and where."""

    def anchors(group: pd.DataFrame) -> pd.DataFrame:
        own, _ = Windows(unpack(group), length).anchors()
        rows = [(block, group["piece"].iloc[0], pack_keys(own[part])) for block, part in by_block(own, count)]
        return pd.DataFrame(rows, columns=["block", "piece", "keys"])

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        distinct, at = met([unpack_keys(x) for x in group["keys"]])
        askers = np.bincount(np.concatenate(at), minlength=len(distinct))
        return pd.DataFrame({"piece": group["piece"], "block": group["block"], "common": [pack_flags(askers[x] > 1) for x in at]})

    def candidates(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = Windows(unpack(group), length)
        _, anchor = own.anchors()
        hashes, first, start, _ = own.index(in_order(answers, "common", unpack_flags, bool)[anchor])
        low = int(first.min(initial=0))
        rows = [(block, group["piece"].iloc[0], pack_keys(hashes[part]), low, pack_ints(first[part] - low), pack_ints(start[part])) for block, part in by_block(hashes, count)]
        return pd.DataFrame(rows, columns=["block", "piece", "keys", "low", "ids", "places"])

    def earlier(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece")
        distinct, at = met([unpack_keys(x) for x in group["keys"]])
        ids = [low + unpack_ints(x).astype(np.int64) for low, x in zip(group["low"], group["ids"])]
        least, whose, where = np.full(len(distinct), NOBODY), np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
        for k, (own, mine, places) in enumerate(zip(at, ids, group["places"])):
            better = mine < least[own]
            new = own[better]
            least[new], whose[new], where[new] = mine[better], k, unpack_ints(places)[better]
        rows, names = [], group["piece"].to_numpy()
        for piece, own, mine in zip(names, at, ids):
            found = least[own] < mine
            of = own[found]
            askers, which = np.unique(whose[of], return_inverse=True)
            rows.append((piece, group["block"].iloc[0], pack_flags(found), names[askers].tolist(), pack_ints(which), pack_ints(where[of])))
        return pd.DataFrame(rows, columns=["piece", "block", "found", "pieces", "which", "places"])

    asked = spread(answer(ask(pieces, anchors, "block int, piece long, keys binary"), count, shared, "piece long, block int, common binary"), "piece", count)
    sent = receive(pieces, asked, candidates, "block int, piece long, keys binary, low long, ids binary, places binary")
    told = answer(sent, count, earlier, "piece long, block int, found binary, pieces array<long>, which binary, places binary")
    return spread(told, "piece", count).unionByName(asked, allowMissingColumns=True)


PARSED = "piece long, asker long, starts binary, words binary, places binary, digests binary, refs array<long>, which binary"


def parse(pieces: DataFrame, answered: DataFrame, length: int) -> DataFrame:
    """Rows to pieces: each piece's own factors (asker null), and the factors of others (asker) to be tested there."""

    def parsed(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows, name = unpack(group), int(group["piece"].iloc[0])
        own = Windows(rows, length)
        _, anchor = own.anchors()
        asked = in_order(answers[answers["common"].notna()], "common", unpack_flags, bool)[anchor]
        hashes, first, start, place = own.index()
        ref = np.where(first[place] < own.ids[own.owner], name, -1)
        spot = np.where(ref >= 0, start[place], 0)
        # keys that were asked for are the distinct hashes of the windows asked for, in the same order
        sent = np.zeros(len(hashes), dtype=bool)
        sent[place[asked]] = True
        told = answers[answers["found"].notna()].sort_values("block")
        found = np.flatnonzero(sent)[in_order(told, "found", unpack_flags, bool)]
        at_piece = np.concatenate([NONE, *(np.array(x, dtype=np.int64)[unpack_ints(y).astype(np.int64)] for x, y in zip(told["pieces"], told["which"]) if len(x))])
        at_place = in_order(told, "places", unpack_ints, np.int64)
        other_piece, other_place = np.full(len(hashes), -1), np.zeros(len(hashes), dtype=np.int64)
        other_piece[found], other_place[found] = at_piece, at_place
        better = other_piece[place] >= 0
        ref[better], spot[better] = other_piece[place][better], other_place[place][better]
        hit = ref >= 0
        own_factors = factors(own.start[hit], own.owner[hit], ref[hit], spot[hit], length)
        words = Words(rows, own.counts)
        marks = [words.digest(s, n) for s, n in own_factors[:, :2].tolist()]
        refs, which = np.unique(own_factors[:, 2], return_inverse=True)
        out = [(name, None, pack_ints(own_factors[:, 0]), pack_ints(own_factors[:, 1]), pack_ints(own_factors[:, 3]), None, refs.tolist(), pack_ints(which))]
        for at in np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1]) if len(refs) else []:
            tests = dict.fromkeys((*own_factors[i, [3, 1]].tolist(), marks[i]) for i in at)
            places, sizes, digests = zip(*tests)
            out.append((int(own_factors[at[0], 2]), name, None, pack_ints(np.array(sizes)), pack_ints(np.array(places)), b"".join(digests), None, None))
        return pd.DataFrame(out, columns=["piece", "asker", "starts", "words", "places", "digests", "refs", "which"]).astype({"asker": "Int64"})

    return receive(pieces, answered, parsed, PARSED)


REFUSED = "piece long, ref long, starts binary, words binary, places binary, refs array<long>, which binary"


def tested(pieces: DataFrame, rows: DataFrame) -> DataFrame:
    """Each piece's own factors, and (with ref) those of its factors whose words differ from their reference's."""

    def test(group: pd.DataFrame, to: pd.DataFrame) -> pd.DataFrame:
        own, asked = to[to["asker"].isna()], to[to["asker"].notna()]
        out = [(x.piece, None, x.starts, x.words, x.places, x.refs, x.which) for x in own.itertuples()]
        if len(asked):
            texts = unpack(group)
            words = Words(texts, words_of(texts["text"].tolist())[1])
            for x in asked.itertuples():
                tests = zip(unpack_ints(x.places).tolist(), unpack_ints(x.words).tolist(), range(0, len(x.digests), DIGEST))
                bad = np.array([(n, p) for p, n, k in sorted(tests) if words.digest(p, n) != x.digests[k : k + DIGEST]], dtype=np.int64).reshape(-1, 2)
                if len(bad):
                    out.append((x.asker, x.piece, None, pack_ints(bad[:, 0]), pack_ints(bad[:, 1]), None, None))
        return pd.DataFrame(out, columns=["piece", "ref", "starts", "words", "places", "refs", "which"]).astype({"ref": "Int64"})

    return receive(pieces, rows, test, REFUSED)


def agreed(rows: pd.DataFrame) -> np.ndarray:
    """(start, words) of a piece's factors, without those refused."""
    own, bad = rows[rows["ref"].isna()].iloc[0], rows[rows["ref"].notna()]
    start, words, places = (unpack_ints(own[c]).astype(np.int64) for c in ("starts", "words", "places"))
    refs = np.array(own["refs"], dtype=np.int64)[unpack_ints(own["which"]).astype(np.int64)] if len(start) else NONE
    keep = np.ones(len(start), dtype=bool)
    for x in bad.itertuples():
        for n, p in zip(unpack_ints(x.words).tolist(), unpack_ints(x.places).tolist()):
            keep &= ~((refs == x.ref) & (words == n) & (places == p))
    return np.stack([start[keep], words[keep]], axis=1)


def reduced(df: DataFrame, id_col: str, text_col: str, length: int, use: Callable[[object, str | None, np.ndarray], tuple], schema: str) -> DataFrame:
    """What ``use`` makes of each row's id, text, and a mark for each word that goes."""
    count = blocks_for(df, text_col)
    pieces = packed(df, id_col, text_col, count)
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(group: pd.DataFrame, to: pd.DataFrame) -> pd.DataFrame:
        rows = unpack(group)
        counts = [len((t or "").encode("utf-8").split()) for t in rows["text"]]
        spans = agreed(to)
        edges = np.zeros(sum(counts) + 1, dtype=np.int64)
        np.add.at(edges, spans[:, 0], 1)
        np.add.at(edges, spans.sum(axis=1), -1)
        gone, out, at = np.cumsum(edges[:-1]) > 0, [], 0
        for name, text, n in zip(rows["id"], rows["text"], counts):
            out.append(use(None if pd.isna(name) else int(name), text, gone[at : at + n]))
            at += n
        return pd.DataFrame(out, columns=names).astype({"id": "Int64"})

    found = found_windows(pieces, count, length)
    return receive(pieces, tested(pieces, parse(pieces, found, length)), cut, schema)


def kept_words(text: str | None, gone: np.ndarray) -> bytes:
    return b" ".join(w for w, x in zip((text or "").encode("utf-8").split(), gone.tolist()) if not x)


def removal_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of every row."""

    def use(name: int | None, text: str | None, gone: np.ndarray) -> tuple:
        return name, len(gone), int(gone.sum()), hashlib.sha256(kept_words(text, gone)).hexdigest()

    return reduced(df, id_col, text_col, length, use, "id long, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("id", id_col)


def without_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, text (kept words, joined by blanks) and spans (from, to word places that go) of every row; a null text stays null."""

    def use(name: int | None, text: str | None, gone: np.ndarray) -> tuple:
        spans = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2).tolist()
        return name, None if text is None else kept_words(text, gone).decode("utf-8"), spans

    return reduced(df, id_col, text_col, length, use, "id long, text string, spans array<array<long>>").withColumnsRenamed({"id": id_col, "text": text_col})
