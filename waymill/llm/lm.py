"""Language-model scores by a weighted backoff automaton over runs of up to three words.

States are contexts: the empty one, the start of a text and every word, and every pair of words seen in
training. From a pair's state an arc leads on with each word that was seen after the pair, weighted by its
smoothed probability; for any other word a failure arc, weighted by what the state leaves over, leads to the
state of the pair's last word, and from there, in the same way, another one to the empty context, whose arcs hold
the smoothed word probabilities. So an unseen run follows a chain of failure arcs. An arc's target is the state of
the longest context seen; a text is read once, from left to right, and its log10 weights are summed.

With c counts in training, N tokens, V distinct ones, and M the smoothing mass of each order:
p(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1)),
p(w|v)   = (c(v w) + M2 p(w)) / (c(v) + M2),           failure arc M2 / (c(v) + M2),
p(w|u v) = (c(u v w) + M3 p(w|v)) / (c(u v) + M3),     failure arc M3 / (c(u v) + M3).
All sum to one over the words and one unknown word.

Counts are whole-corpus counts: pieces of texts send their runs with their own counts to the hash blocks that
add them up (see ``exchange``). Runs of three go in a second round, and only those whose two pairs other pieces
have too: a run with a pair that one piece alone has is all in that piece, so its own count is the whole one.
Words and runs are told apart by 64-bit hashes. Numbers of tokens are exact.

Null texts count as empty: one end token. Training texts are those whose crc32 of the id as text has another
remainder than the held-out one; ids are integers, and a null id has no remainder and so trains. Repeated rows
train and score one by one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from waymill.llm.exchange import answer, ask, blocks_for, by_block, in_order, met, pack_counts, pack_flags, pack_keys, packed, receive, spread, unpack, unpack_counts, unpack_flags, unpack_keys
from waymill.llm.wordhash import mixed, words_of

FOLDS, HELD_OUT = 5, 1
#: Masses M2, M3 of the lower order in the states of one word and of two.
MASS, PAIR_MASS = 300.0, 10.0
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def held_out(ids: pd.Series) -> np.ndarray:
    return np.array([not pd.isna(i) and zlib.crc32(str(int(i)).encode()) % FOLDS == HELD_OUT for i in ids], dtype=bool)


class Tokens:
    """A piece's tokens, text by text with the end token, the state before each, and its distinct words and pairs.

    ``word`` and ``pair`` are places among the distinct ones; ``pair[i]`` is token i with the one before it, or
    with the start. ``first`` marks the first token of each text, where no pair stands before.
    """

    def __init__(self, group: pd.DataFrame):
        rows = unpack(group)
        words, counts = words_of(rows["text"].tolist(), lower=True)
        self.ids, self.sizes = rows["id"], counts + 1
        ends = np.cumsum(self.sizes) - 1
        token = np.empty(int(self.sizes.sum()), dtype=np.uint64)
        inside = np.ones(len(token), dtype=bool)
        inside[ends] = False
        token[inside], token[ends] = words, END
        self.starts = ends - counts
        before = np.r_[START, token[:-1]]
        before[self.starts] = START
        self.first = np.zeros(len(token), dtype=bool)
        self.first[self.starts] = True
        self.held = held_out(rows["id"])
        self.trains = np.repeat(~self.held, self.sizes)
        self.words, self.word = np.unique(token, return_inverse=True)
        self.pairs, self.pair = np.unique(mixed(before) + token, return_inverse=True)
        self.word_count, self.pair_count = (self.own_counts(at, len(keys)) for at, keys in ((self.word, self.words), (self.pair, self.pairs)))

    def own_counts(self, places: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(places, weights=self.trains, minlength=size).astype(np.int64)

    def add_triples(self) -> None:
        """Distinct triples by the pairs that they are made of, so no text is hashed again; the first of a text has none."""
        last = self.pair
        context = np.r_[last[:1], last[:-1]]
        key = mixed(self.pairs[context]) + self.pairs[last]
        key[self.first] = 0  # no triple: counted nowhere
        self.triples, self.triple = np.unique(key, return_inverse=True)
        self.triple_count = self.own_counts(self.triple, len(self.triples))
        some = np.zeros(len(self.triples), dtype=np.int64)
        some[self.triple] = np.arange(len(self.triple))
        self.triple_pairs = context[some], last[some]


ASKED = "block int, piece long, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWERED = "piece long, block int, word_counts binary, pair_counts binary, common binary, tokens long, types long"


def short_runs(pieces: DataFrame, count: int) -> DataFrame:
    """For each piece and block: whole counts of its words and pairs, which pairs other pieces have too, and the block's tokens and types."""

    def questions(group: pd.DataFrame) -> pd.DataFrame:
        own = Tokens(group)
        words, pairs = (dict(by_block(keys, count)) for keys in (own.words, own.pairs))
        none, rows = slice(0, 0), []
        for k in sorted(words.keys() | pairs.keys()):
            w, p = words.get(k, none), pairs.get(k, none)
            rows.append((k, group["piece"].iloc[0], pack_keys(own.words[w]), pack_counts(own.word_count[w]), pack_keys(own.pairs[p]), pack_counts(own.pair_count[p])))
        return pd.DataFrame(rows, columns=["block", "piece", "words", "word_counts", "pairs", "pair_counts"])

    def answers(group: pd.DataFrame) -> pd.DataFrame:
        word_total, word_at = totals(group["words"], group["word_counts"])
        pair_total, pair_at = totals(group["pairs"], group["pair_counts"])
        askers = np.bincount(np.concatenate(pair_at), minlength=len(pair_total))
        tokens, types, rows = int(word_total.sum()), int((word_total > 0).sum()), []
        for piece, w, p in zip(group["piece"], word_at, pair_at):
            rows.append((piece, group["block"].iloc[0], pack_counts(word_total[w]), pack_counts(pair_total[p]), pack_flags(askers[p] > 1), tokens, types))
        return pd.DataFrame(rows, columns=["piece", "block", "word_counts", "pair_counts", "common", "tokens", "types"])

    return spread(answer(ask(pieces, questions, ASKED), count, answers, ANSWERED), "piece", count)


def totals(keys: pd.Series, counts: pd.Series) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sums of the counts of distinct keys, and where those of each question are among them."""
    distinct, at = met([unpack_keys(x) for x in keys])
    weights = np.concatenate([np.zeros(0, dtype=np.int64), *map(unpack_counts, counts)])
    return np.bincount(np.concatenate(at), weights=weights, minlength=len(distinct)).astype(np.int64), at


def long_runs(pieces: DataFrame, answered: DataFrame, count: int) -> DataFrame:
    """The answers about words and pairs of each piece, and the whole counts of the triples that it asked for."""

    def questions(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = Tokens(group)
        own.add_triples()
        asked = own.triples[open_triples(own, in_order(answers, "common", unpack_flags, bool))]
        counts = own.triple_count[np.searchsorted(own.triples, asked)]
        rows = [(k, group["piece"].iloc[0], pack_keys(asked[at]), pack_counts(counts[at])) for k, at in by_block(asked, count)]
        return pd.DataFrame(rows, columns=["block", "piece", "keys", "counts"])

    def sums(group: pd.DataFrame) -> pd.DataFrame:
        total, at = totals(group["keys"], group["counts"])
        return pd.DataFrame({"piece": group["piece"], "block": group["block"], "triple_counts": [pack_counts(total[x]) for x in at]})

    asked = receive(pieces, answered, questions, "block int, piece long, keys binary, counts binary")
    told = answer(asked, count, sums, "piece long, block int, triple_counts binary")
    return spread(told, "piece", count).unionByName(answered, allowMissingColumns=True)


def open_triples(own: Tokens, common: np.ndarray) -> np.ndarray:
    """Which triples other pieces may have: those whose pairs are common."""
    context, last = own.triple_pairs
    return common[context] & common[last] & (own.triples != 0)


def learn(own: Tokens, answers: pd.DataFrame) -> tuple[int, int]:
    """Puts the whole corpus's counts in place of a piece's own; the corpus's tokens and types."""
    short = answers[answers["common"].notna()]
    own.word_count, own.pair_count = (in_order(short, c, unpack_counts, np.int64) for c in ("word_counts", "pair_counts"))
    own.add_triples()
    asked = open_triples(own, in_order(short, "common", unpack_flags, bool))
    own.triple_count[asked] = in_order(answers[answers["triple_counts"].notna()], "triple_counts", unpack_counts, np.int64)
    return int(short["tokens"].sum()), int(short["types"].sum())


class Automaton:
    """The part of the automaton that a piece's texts walk: log10 weights of its arcs and of its states' failure arcs.

    States are numbered: 0 the empty context, then the start of a text, the piece's words and its pairs.
    """

    def __init__(self, own: Tokens, tokens: int, types: int, masses: tuple[float, float]):
        words, pairs = len(own.words), len(own.pairs)
        self.word_state, self.pair_state = 2, 2 + words
        texts = own.word_count[np.searchsorted(own.words, END)]
        reached = np.r_[0, texts, own.word_count]
        # the word before and the word of each pair, by one place where it stands
        last, before = np.zeros(pairs, dtype=np.int64), np.zeros(pairs, dtype=np.int64)
        last[own.pair] = own.word
        before[own.pair] = np.where(own.first, 1, self.word_state + np.r_[0, own.word[:-1]])
        self.fail = np.r_[0, np.zeros(1 + words, dtype=np.int64), self.word_state + last]
        self.leave = np.log10(np.r_[1.0, masses[0] / (reached[1:] + masses[0]), masses[1] / (own.pair_count + masses[1])])
        self.word_arc = np.log10((own.word_count + 0.5) / (tokens + 0.5 * (types + 1)))
        lower = 10.0 ** self.word_arc[last]
        smooth = (own.pair_count + masses[0] * lower) / (reached[before] + masses[0])
        self.pair_arc = np.where(own.pair_count > 0, np.log10(smooth), -np.inf)
        context, ending = own.triple_pairs
        smooth = (own.triple_count + masses[1] * smooth[ending]) / (own.pair_count[context] + masses[1])
        self.triple_arc = np.where((own.triple_count > 0) & (own.triples != 0), np.log10(smooth), -np.inf)

    def walk(self, own: Tokens) -> np.ndarray:
        """The weight of each token's step, failure arcs and arc together.

        Whatever arc reads a token, it leads to the longest context seen up to there, so the state that a text
        carries to its next token is known from two tokens, and the steps of all texts can be taken at once.
        """
        after = np.where(own.pair_count[own.pair] > 0, self.pair_state + own.pair, np.where(own.word_count[own.word] > 0, self.word_state + own.word, 0))
        state = np.where(own.first, 1, np.r_[0, after[:-1]])
        step, todo = np.zeros(len(state)), np.arange(len(state))
        while len(todo):
            at = state[todo]
            arc = np.where(at >= self.pair_state, self.triple_arc[own.triple[todo]], np.where(at >= 1, self.pair_arc[own.pair[todo]], self.word_arc[own.word[todo]]))
            taken = np.isfinite(arc)
            step[todo[taken]] += arc[taken]
            todo, at = todo[~taken], at[~taken]
            step[todo] += self.leave[at]
            state[todo] = self.fail[at]
        return step


def score_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", masses: tuple[float, float] = (MASS, PAIR_MASS)) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    count = blocks_for(df, text_col)
    pieces = packed(df, id_col, text_col, count)
    columns = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def report(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = Tokens(group)
        tokens, types = learn(own, answers)
        model = Automaton(own, tokens, types, masses)
        base, score = (np.add.reduceat(x, own.starts) for x in (model.word_arc[own.word], model.walk(own)))
        known = np.add.reduceat((own.word_count > 0)[own.word].astype(np.int64), own.starts)
        out = pd.DataFrame({"id": own.ids, "held_out": own.held, "n_tokens": own.sizes, "n_known": known, "train_tokens": tokens, "base_score": base, "score": score}, columns=columns)
        return out.astype({"id": "Int64"})

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    answered = long_runs(pieces, short_runs(pieces, count), count)
    return receive(pieces, answered, report, schema).withColumnRenamed("id", id_col)
