"""Compressed FM-index over sequences of symbols: wavelet matrix and matching statistics."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank over a sequence of numbers: one packed bit row for each bit of the symbols."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.shifts = list(range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1))
        self.words, self.before, self.zeros = [], [], []
        n = len(sequence)
        for shift in self.shifts:
            bits = ((sequence >> shift) & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: (n + 7) // 8] = np.packbits(bits, bitorder="little")
            words = packed.view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(n - int(ones.sum()))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])
        #: where the run of each symbol begins in the order of the last row
        self.begin = self.place(np.arange(symbols), np.zeros(symbols, np.int64))

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``begin`` of the symbol plus how often it stands before ``at``."""
        one = np.uint64(1)
        for shift, words, before, zeros in zip(self.shifts, self.words, self.before, self.zeros):
            word = at >> 6
            inside = words[word] & ((one << (at & 63).astype(np.uint64)) - one)
            ones = before[word] + np.bitwise_count(inside)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Index of weighted passages (lists of words), for patterns of up to ``depth`` words.

    Suffixes are ordered by prefix doubling up to at least ``depth`` words,
    which is all that backward search for such patterns needs.
    """

    def __init__(self, passages: list[list[bytes]], weights: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.lengths = np.array([len(p) for p in passages], np.int64)
        ids: dict[bytes, int] = {}
        number = ids.setdefault
        # Symbol 0 ends every passage.
        self.text = np.fromiter(
            (x for p in passages for x in (*(number(w, len(ids) + 1) for w in p), 0)),
            np.int64,
            int(self.lengths.sum()) + len(passages),
        )
        n = len(self.text)
        order, same = self._suffixes(n)
        self.symbols = len(ids) + 1
        self.wavelet = WaveletMatrix(self.text[order - 1], self.symbols)
        first = np.cumsum(np.bincount(self.text, minlength=self.symbols))
        self.shift = np.concatenate([[0], first[:-1]]) - self.wavelet.begin
        self.weight = np.concatenate([[0], np.cumsum(np.repeat(weights, self.lengths + 1)[order])])
        # Runs of suffixes that agree in depth - 1 words: where the run of each place begins and ends.
        place = np.arange(n)
        self.run_begin = np.maximum.accumulate(np.where(same, 0, place))
        ends = np.where(np.append(~same[1:], True), place + 1, n)
        self.run_end = np.minimum.accumulate(ends[::-1])[::-1]

    def _suffixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The order of the suffixes, and where one agrees with the last in depth - 1 words."""
        ranks = {1: self.text}
        rank, h = self.text, 1
        order = np.argsort(rank, kind="stable")
        while h < self.depth:
            key = rank * (int(rank.max(initial=0)) + 1)
            key[: n - h] += rank[h:]
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            h *= 2
            ranks[h] = rank
        same = np.ones(n, bool)
        at, left = order, self.depth - 1
        for size in sorted(ranks, reverse=True):
            if size <= left:
                value = np.where(at < n, ranks[size][np.minimum(at, n - 1)], -1)
                same[1:] &= value[1:] == value[:-1]
                at, left = at + size, left - size
        same[:1] = False
        return order, same

    def repeats(self) -> np.ndarray:
        """For every passage, a bit for each word at which a pattern of ``depth`` words weighing two or more begins.

        All passages are streamed through the index together, from their last
        word to their first.  A step prepends a word by backward search; once
        ``depth`` words match, the last of them is dropped first, by widening
        the interval to the suffixes that agree in ``depth - 1`` words.  A
        passage's own place is always found, so the match never ends early.
        """
        out = np.zeros(len(self.lengths), np.int64)
        by_length = np.argsort(-self.lengths, kind="stable")
        sizes = self.lengths[by_length]
        last = (np.cumsum(self.lengths + 1) - 2)[by_length]  # place of each passage's last word
        low = np.zeros(len(sizes), np.int64)
        high = np.full(len(sizes), len(self.text), np.int64)
        for step in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(-sizes, -step, side="left"))
            low, high = low[:active], high[:active]
            if step >= self.depth:
                low, high = self.run_begin[low], self.run_end[high - 1]
            symbol = self.text[last[:active] - step]
            both = self.wavelet.place(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = both[:active] + self.shift[symbol], both[active:] + self.shift[symbol]
            if step >= self.depth - 1:
                twice = self.weight[high] - self.weight[low] >= 2
                at = sizes[:active] - 1 - step
                out[by_length[:active]] |= np.where(twice, np.int64(1) << np.minimum(at, 62), 0)
        return out
