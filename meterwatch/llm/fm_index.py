"""An FM-index over word numbers: wavelet matrix, backward search of many patterns side by side."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in words of 64 with counts, for ranks of many places at once."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(((n >> 6) + 1) << 6, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = ((symbols >> shift) & 1).astype(bool)
            bits = Bits(bit)
            self.levels.append((shift, bits, len(symbols) - bits.ones))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.start = self._walk(np.arange(size), np.zeros(size, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before its place."""
        return self._walk(symbol, at) - self.start[symbol]


class WindowIndex:
    """FM-index of texts for patterns of up to ``width`` words.

    Suffixes are ordered by their first ``width`` words only, which is all that
    patterns of that length can tell apart. Texts are separated by symbol 0.
    """

    def __init__(self, texts: list[np.ndarray], size: int, width: int):
        self.width, self.size = width, size
        lengths = np.array([len(t) for t in texts], np.int64)
        parts = []
        for t in texts:
            parts += [t, np.zeros(1, np.int64)]
        self.text = np.concatenate(parts).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        self.lengths = lengths
        n = len(self.text)
        ranks, depth = self.text, 1
        while 2 * depth < width:
            ranks = self._paired(ranks, depth)
            depth *= 2
        first, second = ranks, self._ahead(ranks, width - depth)
        order = np.lexsort((second, first))
        self.order = order
        new = np.ones(n, bool)
        new[1:] = (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
        self.classes = np.cumsum(new) - 1            # of equal first ``width`` words
        self.class_starts = np.flatnonzero(new)
        shorter = self._ahead(ranks, width - 1 - depth)
        new = np.ones(n, bool)
        new[1:] = (first[order[1:]] != first[order[:-1]]) | (shorter[order[1:]] != shorter[order[:-1]])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1                   # of equal first ``width - 1`` words
        self.low, self.high = starts[group], np.append(starts[1:], n)[group]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=size))])
        self.wavelet = WaveletMatrix(self.text[order - 1], size)  # the word before each suffix

    @staticmethod
    def _ahead(ranks: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(ranks)
        out[:len(ranks) - by] = ranks[by:]
        return out

    def _paired(self, ranks: np.ndarray, depth: int) -> np.ndarray:
        key = ranks * (int(ranks.max()) + 1) + self._ahead(ranks, depth)
        return np.unique(key, return_inverse=True)[1].astype(np.int64)

    def extend(self, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of patterns with one more word in front."""
        return self.before[word] + self.wavelet.rank(word, low), self.before[word] + self.wavelet.rank(word, high)

    def window_classes(self) -> list[np.ndarray]:
        """For each text, the class of every window of ``width`` words, found by backward search.

        All texts are streamed from their ends at once. A match that has grown to
        ``width`` words is reported and cut to its first ``width - 1`` words.
        """
        out = [np.zeros(max(0, n - self.width + 1), np.int64) for n in self.lengths]
        flat = np.concatenate([*out, np.zeros(0, np.int64)])
        offset = np.concatenate([[0], np.cumsum([len(o) for o in out])[:-1]]).astype(np.int64)
        lane = np.flatnonzero(self.lengths >= self.width)
        low, high = np.zeros(len(lane), np.int64), np.full(len(lane), len(self.text), np.int64)
        at = self.lengths[lane] - 1
        matched = 0
        while len(lane):
            low, high = self.extend(low, high, self.text[self.begins[lane] + at])
            matched += 1
            if matched >= self.width:
                flat[offset[lane] + at] = self.classes[low]
                low, high = self.low[low], self.high[low]
                matched = self.width - 1
            at = at - 1
            alive = at >= 0
            if not alive.all():
                lane, low, high, at = lane[alive], low[alive], high[alive], at[alive]
        return [flat[o:o + len(w)] for o, w in zip(offset, out)]

    def smallest(self, numbers: np.ndarray) -> np.ndarray:
        """For every class of windows, the smallest number of the texts that hold it."""
        owner = np.repeat(numbers, self.lengths + 1)
        return np.minimum.reduceat(owner[self.order], self.class_starts)
