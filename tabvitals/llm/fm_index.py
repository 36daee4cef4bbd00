"""A bidirectional FM-index over delimited words, and its search with one error.

The text of the index is `$w1$w2$...$` of distinct words in ascending order. A pattern's state is
its interval of suffix ranks in the index of the text and in that of the reversed text, which have
the same size. Adding a symbol on the left is a backward step in the first index, on the right one
in the second; the other interval moves by the number of smaller symbols that were passed over.
Many queries are searched together: states are columns of arrays, and a step is one for all.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

LEFT, RIGHT = 0, 1
_DELIMITER = 0
#: States with at most so many suffixes look up which symbols follow; others try all symbols.
_FEW = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling. Delimiters count as different, ascending."""
    ends = text == _DELIMITER
    ranks = np.where(ends, np.cumsum(ends) - 1, text + ends.sum()).astype(np.int64)
    width, size = 1, len(text)
    while True:
        following = np.zeros(size, np.int64)
        following[:-width] = ranks[width:] + 1
        keys = ranks * (max(size, ranks.max()) + 2) + following
        order = np.argsort(keys, kind="stable")
        steps = np.diff(keys[order]) != 0
        ranks = np.empty(size, np.int64)
        ranks[order] = np.concatenate([[0], np.cumsum(steps)])
        width *= 2
        if steps.all() or width >= size:
            return order


class _Index:
    """Ranks over the last column of a sorted text: how many smaller symbols precede a row."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        order = suffix_order(text)
        # The row of the whole text has nothing before it: a symbol above all others.
        self.last = np.where(order > 0, text[order - 1], n_symbols).astype(np.int64)
        self.first = np.searchsorted(np.sort(text), np.arange(n_symbols + 1))
        n_words = len(text) // 64 + 1
        self.bits = np.zeros((n_symbols + 1, n_words), np.uint64)
        self.counts = np.zeros((n_symbols + 1, n_words), np.int64)
        padded = np.full(n_words * 64, n_symbols, np.int64)
        padded[: len(text)] = self.last
        for symbol in range(1, n_symbols + 1):
            packed = np.packbits(padded < symbol, bitorder="little").view(np.uint64)
            self.bits[symbol] = packed
            self.counts[symbol, 1:] = np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]

    def smaller(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How many of the first `rows` rows have a symbol below the given one."""
        word = rows >> 6
        mask = (np.uint64(1) << (rows & 63).astype(np.uint64)) - np.uint64(1)
        tail = np.bitwise_count(self.bits[symbols, word] & mask)
        return self.counts[symbols, word] + tail


def symbols_of(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in one array, and the words' lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


class BidirectionalIndex:
    """Both indexes of distinct words in ascending order of their code points."""

    def __init__(self, words: Sequence[str]):
        flat, lengths = symbols_of(words)
        self.n_words = len(words)
        self.alphabet = np.unique(flat)  # symbols are places in it, from 1
        self.n_symbols = len(self.alphabet) + 1
        text = np.zeros(len(flat) + len(words) + 1, np.int64)
        letters = np.ones(len(text), bool)
        letters[0] = False
        letters[np.cumsum(lengths + 1)] = False
        text[letters] = np.searchsorted(self.alphabet, flat) + 1
        self.sides = (_Index(text, self.n_symbols), _Index(text[::-1], self.n_symbols))

    def queries(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words as rows of a matrix, -1 for strange ones, and their lengths."""
        flat, lengths = symbols_of(words)
        places = np.searchsorted(self.alphabet, flat)
        known = self.alphabet[np.minimum(places, len(self.alphabet) - 1)] == flat
        matrix = np.full((len(words), lengths.max(initial=0) + 1), -1, np.int64)
        matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = np.where(known, places + 1, -1)
        return matrix, lengths

    def extended(self, state: np.ndarray, symbols: np.ndarray, side: int) -> np.ndarray:
        """States (own interval's start, the other's, size) with a symbol more on that side.

        `own` is the interval in the index that steps. A strange symbol leaves nothing.
        """
        own, other, size = state
        index = self.sides[side]
        known = symbols >= 0
        symbols = np.where(known, symbols, 0)
        above, end = np.minimum(symbols + 1, self.n_symbols), own + size
        below_start, below_end = index.smaller(symbols, own), index.smaller(symbols, end)
        start = index.smaller(above, own) - below_start
        found = index.smaller(above, end) - below_end - start
        return np.stack(
            [
                index.first[symbols] + start,
                other + below_end - below_start,
                np.where(known, found, 0),
            ]
        )

    def followers(self, state: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of states and letters that stand next to them on that side, each pair once."""
        own, _, size = state
        few = np.flatnonzero(size <= _FEW)
        many = np.flatnonzero(size > _FEW)
        at = np.repeat(few, size[few])
        within = np.arange(len(at)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        letters = self.sides[side].last[own[at] + within]
        width = self.n_symbols + 1
        pairs = np.unique(at * width + letters)
        pairs = pairs[(pairs % width > _DELIMITER) & (pairs % width < self.n_symbols)]
        all_letters = np.arange(1, self.n_symbols)
        return (
            np.concatenate([pairs // width, np.repeat(many, len(all_letters))]),
            np.concatenate([pairs % width, np.tile(all_letters, len(many))]),
        )

    def near(self, words: Sequence[str], exact: np.ndarray, side: int) -> np.ndarray:
        """Pairs (place in `words`, place in the index) that differ by one symbol, each once.

        With RIGHT, the first `exact` symbols are the same and the error is in the rest; with LEFT
        the last ones are, and the error is before them. The exact part is matched from the word's
        edge on, then the rest with one symbol inserted, deleted or replaced, up to the other edge.
        """
        if not self.n_words or not len(words):
            return np.zeros((2, 0), np.int64)
        oriented = words if side == RIGHT else [w[::-1] for w in words]
        matrix, lengths = self.queries(oriented)
        query = np.arange(len(words))
        whole = np.full(len(words), self.n_words + 1)
        state = np.stack([np.zeros_like(whole), np.zeros_like(whole), whole])
        for place in range(int(exact.max())):
            step = place < exact[query]
            moved = self.extended(state[:, step], matrix[query[step], place], side)
            state[:, step] = moved
            alive = state[2] > 0
            query, state = query[alive], state[:, alive]
        place = exact[query]
        wrong: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query, place, state
        found = []
        while len(query) or wrong:
            late = [(query[:0], place[:0], state[:, :0])] if not wrong else wrong
            late = [np.concatenate(parts, axis=-1) for parts in zip(*late, strict=True)]
            wrong = []
            if len(query):
                at, letters = self.followers(state, side)
                more = self.extended(state[:, at], letters, side)
                alive = more[2] > 0
                at, letters, more = at[alive], letters[alive], more[:, alive]
                same = letters == matrix[query[at], place[at]]
                other = ~same & (place[at] < lengths[query[at]])
                inside = place < lengths[query]
                wrong = [
                    (query[at], place[at], more),  # inserted
                    (query[at[other]], place[at[other]] + 1, more[:, other]),  # replaced
                    (query[inside], place[inside] + 1, state[:, inside]),  # deleted
                ]
                query, place, state = query[at[same]], place[at[same]] + 1, more[:, same]
            late_query, late_place, late_state = late
            if len(late_query):
                ended = late_place == lengths[late_query]
                symbols = np.where(ended, _DELIMITER, matrix[late_query, late_place])
                late_state = self.extended(late_state, symbols, side)
                alive = late_state[2] > 0
                hit = alive & ended
                # The interval of `$word$` in the text's own index starts at the word's place.
                ranks = late_state[0] if side == LEFT else late_state[1]
                found.append(late_query[hit] * self.n_words + ranks[hit])
                on = alive & ~ended
                wrong.append((late_query[on], late_place[on] + 1, late_state[:, on]))
            wrong = [part for part in wrong if len(part[0])]
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        return np.stack([pairs // self.n_words, pairs % self.n_words])
