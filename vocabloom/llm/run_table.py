"""Token runs of words: a merge agenda over batches of words, and a bounded store of its results."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np

from vocabloom.llm._common import spread

NONE = np.int32(2**31 - 1)
#: Symbols above which a word has an agenda of its own.
LONG = 64


class PairAgenda:
    """Merges adjacent symbols, the best-ranked pair of a word first and of equal ranks the leftmost.

    ``pairs`` maps (left, right) to (rank, merged symbol). Words of a batch take their next
    merge together, and only the two pairs beside a merge are looked up again. A word of more than LONG symbols
    has an agenda of its own, a heap in the same order, so its time grows with its length times the logarithm.
    """

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        order = np.argsort(keys)
        self.keys = np.concatenate([keys[order], [np.iinfo(np.int64).max]])
        self.ranks = np.concatenate([values[order, 0], [NONE]]).astype(np.int32)
        self.merged = np.concatenate([values[order, 1], [0]])

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the pairs in the table; its last place stands for no pair."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.keys) - 1)

    @cached_property
    def _table(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys[:-1].tolist(), zip(self.ranks.tolist(), self.merged.tolist())))

    def _alone(self, symbols: np.ndarray) -> np.ndarray:
        """What is left of one word's symbols."""
        sym, n, find = symbols.tolist(), len(symbols), self._table.get
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)
        ranks = self.ranks[self._find(symbols[:-1], symbols[1:])].astype(np.int64)
        at = np.flatnonzero(ranks != NONE)
        agenda = (ranks[at] << 32 | at).tolist()
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            at = entry & 0xFFFFFFFF
            right = after[at]
            if gone[at] or right == n or (pair := find(sym[at] << 32 | sym[right])) is None or pair[0] != entry >> 32:
                continue  # a neighbour has been merged since
            sym[at], gone[right], far, left = pair[1], 1, after[right], before[at]
            after[at] = far
            if far < n:
                before[far] = at
                if pair := find(sym[at] << 32 | sym[far]):
                    heappush(agenda, pair[0] << 32 | at)
            if left >= 0 and (pair := find(sym[left] << 32 | sym[at])):
                heappush(agenda, pair[0] << 32 | left)
        return np.array(sym, np.int64)[np.frombuffer(gone, np.uint8) == 0]

    def run(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words laid end to end; returns what is left of them and the new lengths."""
        last_pair = len(self.keys) - 1
        done_symbols, done_words = [], []
        sym, word = symbols.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
        alone = np.flatnonzero(lengths > LONG)
        if len(alone):
            ends = np.cumsum(lengths)
            for k in alone.tolist():
                left = self._alone(sym[ends[k] - lengths[k] : ends[k]])
                done_symbols.append(left)
                done_words.append(np.full(len(left), k))
            short = np.repeat(lengths <= LONG, lengths)
            sym, word = sym[short], word[short]
        pair = np.full(len(sym), last_pair)
        inner = np.flatnonzero(word[:-1] == word[1:]) if len(sym) else np.zeros(0, np.int64)
        pair[inner] = self._find(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            rank = self.ranks[pair]
            sizes = np.diff(np.concatenate([first, [len(sym)]]))
            best = np.repeat(np.minimum.reduceat(rank, first), sizes)
            open_ = best != NONE
            if not open_.all():
                done_symbols.append(sym[~open_])
                done_words.append(word[~open_])
                sym, word, pair, rank, best = sym[open_], word[open_], pair[open_], rank[open_], best[open_]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            sym[at] = self.merged[pair[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            sym, word, pair = sym[keep], word[keep], pair[keep]
            pair[at] = last_pair
            right = at[(at + 1 < len(sym)) & (word[np.minimum(at + 1, len(sym) - 1)] == word[at])]
            pair[right] = self._find(sym[right], sym[right + 1])
            left = at[(at > 0) & (word[np.maximum(at - 1, 0)] == word[at])]
            pair[left - 1] = self._find(sym[left - 1], sym[left])
        none = np.zeros(0, np.int64)
        sym, word = np.concatenate([none, *done_symbols]), np.concatenate([none, *done_words])
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(lengths)).astype(np.int64)


class RunTable:
    """Encodes each different word once; forgets all when it holds ``most`` words or ``most_tokens`` of their tokens.

    ``encode`` takes new words and returns their runs end to end and the length of each.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 400_000, most_tokens: int = 8_000_000):
        self.encode, self.most, self.most_tokens = encode, most, most_tokens
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint16)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        runs, lengths = self.encode(words)
        first, n, total = len(self.rows), len(words), len(runs)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used : self.used + total] = runs
        self.lengths[first : first + n] = lengths
        self.starts[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.rows.update(zip(words, range(first, first + n)))
        self.used += total

    def tokens(self, words: list[str], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of words[at[0]], words[at[1]], ... end to end, and the length of each; ``words`` are distinct."""
        rows = np.fromiter(map(self.rows.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            if len(self.rows) + len(missing) > self.most or self.used > self.most_tokens:
                self._clear()
                missing = np.arange(len(words))
            rows[missing] = len(self.rows) + np.arange(len(missing))
            self._learn([words[i] for i in missing])
        of = rows[at]
        lengths = self.lengths[of]
        return self.flat[spread(self.starts[of], lengths)], lengths
