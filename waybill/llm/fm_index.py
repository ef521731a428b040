"""Words one edit apart by search schemes over an FM-index of a delimited vocabulary.

A word is cut into two halves. One edit lies in one of them, so the other stands unchanged: it is matched exactly, and the
match is extended across the edited half with exactly one error. All searches of a vocabulary advance together, one symbol
a step, as arrays of suffix-rank intervals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: The delimiter's symbol; letters follow in code-point order.
END = 0


class Index:
    """FM-index of ``$w1$w2..$wn$``, read from the right. Turn all words round to read from the left."""

    def __init__(self, words: Sequence[str]) -> None:
        text = "\0" + "\0".join(words) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.letters, symbols = np.unique(points, return_inverse=True)
        symbols = symbols.astype(np.int64)
        self.size, self.words = len(symbols), len(words)
        order = _suffix_order(symbols)
        self.before = symbols[order - 1]  # the symbol in front of each suffix, in suffix order
        # Occurrences of each symbol in that column, sorted by (symbol, rank): the number of entries below (c, i) is the
        # rank at which the suffixes that begin with c and go on with suffix i or a later one start.
        ranks = np.argsort(self.before, kind="stable")
        self.places = self.before[ranks] * self.size + ranks
        starts = np.flatnonzero(symbols == END)
        self.word_at = np.searchsorted(starts, order, side="right") - 1  # the word that a suffix begins in front of or in

    def codes(self, word: str) -> np.ndarray:
        """Symbols of a word; letters that the index does not have are -1."""
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that have ``symbol`` in front of those of [low, high)."""
        key = symbol * self.size
        return np.searchsorted(self.places, key + low), np.searchsorted(self.places, key + high)

    def fronts(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval number, symbol) for every letter that stands in front of a suffix of the interval.

        Short intervals are looked through, long ones are asked for each letter, so none costs more than the alphabet.
        """
        width, alphabet = high - low, len(self.letters)
        short = np.flatnonzero(width <= alphabet)
        of = np.repeat(short, width[short])
        first = np.cumsum(width[short]) - width[short]
        inside = np.arange(len(of)) - np.repeat(first, width[short])
        seen = np.unique(of * alphabet + self.before[low[of] + inside])
        long = np.flatnonzero(width > alphabet)
        asked, letter = np.repeat(long, alphabet), np.tile(np.arange(alphabet), len(long))
        begin, end = self.extend(letter, low[asked], high[asked])
        there = begin < end
        which = np.concatenate([seen // alphabet, asked[there]])
        what = np.concatenate([seen % alphabet, letter[there]])
        return which[what != END], what[what != END]


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start of every suffix in order, by doubling the length that ranks stand for."""
    size, step = len(symbols), 1
    rank = symbols.copy()
    while True:
        further = np.zeros(size, np.int64)
        further[:-step] = rank[step:] + 1
        key = rank * (size + 2) + further
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(size, np.int64)
        rank[order] = new
        if new[-1] == size - 1:
            return order
        step *= 2
        if step >= size:
            return order


def one_edit_apart(index: Index, queries: Sequence[str], exact: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(query number, word number) of the pairs that differ by exactly one inserted, deleted or replaced letter.

    The last ``exact`` letters of a query, and the word's end behind them, stand unchanged; the error lies in front of
    them. Every pair is given once: of the places in a run of one letter that give the same word, the last that is read
    is used. An index of words turned round, asked with queries turned round, gives the errors behind an unchanged
    beginning. The words of the index must be distinct.
    """
    if not len(queries):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    length = np.array([len(q) for q in queries])
    # Symbols are read from the right: ahead[ends[q] - k] is the k-th of query q; in front of each word stands a delimiter.
    ahead = np.concatenate([np.append(index.codes("\0" + q), END) for q in queries])
    ends = np.cumsum(length + 2) - 1
    left = length + 1 - np.array(exact)  # symbols still to match after the exact part, the opening delimiter included
    clean = {"q": np.arange(len(queries)), "k": np.ones(len(queries), np.int64)}
    clean["low"], clean["high"] = index.extend(np.full(len(queries), END), np.zeros(len(queries), np.int64), np.full(len(queries), index.size))
    broken = {name: np.empty(0, np.int64) for name in ("q", "k", "low", "high")}
    pairs = []

    def pick(state, where):
        return {name: values[where] for name, values in state.items()}

    def joined(*states):
        return {name: np.concatenate([s[name] for s in states]) for name in states[0]}

    def step(state, symbol):
        low, high = index.extend(symbol, state["low"], state["high"])
        return {"q": state["q"], "k": state["k"] + 1, "low": low, "high": high}

    def alive(state):
        return pick(state, state["low"] < state["high"])

    while len(clean["q"]) or len(broken["q"]):
        # States with their error behind them only go on; those that closed the word are hits.
        if len(broken["q"]):
            done = broken["k"] == length[broken["q"]] + 2
            pairs.append(pick(broken, done))
            broken = pick(broken, ~done)
            broken = alive(step(broken, ahead[ends[broken["q"]] - broken["k"]]))
        if not len(clean["q"]):
            continue
        open_ = length[clean["q"]] + 2 - clean["k"] <= left[clean["q"]]
        able = pick(clean, open_)
        if len(able["q"]):
            want = ahead[ends[able["q"]] - able["k"]]
            inner = want != END
            # A letter too many in the query is passed over; of a run of one letter, the last that is read.
            following = ahead[ends[able["q"]] - able["k"] - inner]
            skip = pick(able, inner & (want != following))
            skip["k"] = skip["k"] + 1
            which, letter = index.fronts(able["low"], able["high"])
            # Another letter in its place, or one put in before it is read (after a run, if it is the run's own letter).
            other = letter != want[which]
            grown = step(pick(able, which[other]), letter[other])
            swapped = pick(grown, inner[which[other]])
            added = {**grown, "k": grown["k"] - 1}
            broken = joined(broken, skip, alive(swapped), alive(added))
        clean = pick(clean, clean["k"] < length[clean["q"]] + 1)
        clean = alive(step(clean, ahead[ends[clean["q"]] - clean["k"]]))
    hits = joined(*pairs) if pairs else broken
    # Behind the last delimiter the text begins anew, so an empty word is seen there; it is none of the words.
    found = index.word_at[hits["low"]]
    real = found < index.words
    return hits["q"][real], found[real]
