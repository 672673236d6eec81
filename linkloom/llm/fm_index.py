"""A compressed FM-index over sequences of numbers, in numpy, for many queries at once.

The Burrows-Wheeler transform of all sequences is kept in a wavelet tree whose paths are prefix
codes of the symbols' frequencies, as packed bits with counts per machine word. Besides it there
is one small number per place: how many symbols neighbouring suffixes share, up to a bound.
"""

from __future__ import annotations

import numpy as np

_ONE, _63 = np.uint64(1), np.uint64(63)


class _Bits:
    """Packed bits with the number of ones before every machine word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (_ONE << (at.astype(np.uint64) & _63)) - _ONE
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Counts of a symbol before a place. A symbol's path is as long as the symbol is rare."""

    def __init__(self, sequence: np.ndarray, n_symbols: int):
        counts = np.bincount(sequence, minlength=n_symbols)
        share = np.maximum(counts, 1) / max(len(sequence), 1)
        self.lengths = np.maximum(np.ceil(-np.log2(share) - 1e-12), 1).astype(np.int64)
        self.lengths[counts == 0] = 0
        longest, order = int(self.lengths.max(initial=1)), np.argsort(self.lengths, kind="stable")
        order = order[self.lengths[order] > 0]
        spans = np.int64(1) << (longest - self.lengths[order])
        codes = np.zeros(n_symbols, np.int64)
        codes[order] = (np.cumsum(spans) - spans) >> (longest - self.lengths[order])
        self.levels = []
        for depth in range(longest):
            left = self.lengths[sequence] - 1 - depth
            bit = (codes[sequence] >> left) & 1
            # Symbols of one node stand together; every symbol knows where its node begins.
            path = codes[sequence] >> (left + 1)
            first = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
            bits, start = _Bits(bit), np.zeros(n_symbols, np.int64)
            node = np.repeat(first, np.diff(np.append(first, len(path))))
            start[sequence] = node
            way = (codes >> np.maximum(self.lengths - 1 - depth, 0)) & 1
            self.levels.append((bits, start, bits.rank(start), way == 1))
            go_on = left > 0
            sequence = np.concatenate([sequence[go_on & (bit == 0)], sequence[go_on & (bit == 1)]])
            if not len(sequence):
                break

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        at, lanes = np.where(self.lengths[symbol] > 0, at, 0), np.arange(len(at))
        for depth, (bits, start, ones, way) in enumerate(self.levels):
            lanes = lanes[self.lengths[symbol[lanes]] > depth]
            if not len(lanes):
                break
            c, place = symbol[lanes], at[lanes]
            high = bits.rank(start[c] + place) - ones[c]
            at[lanes] = np.where(way[c], high, place - high)
        return at


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order; every 0 is a separator of its own, smaller than what comes later.

    The text ends with a separator, so places double in known length until all differ.
    """
    n, ends = len(text), text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + ends.sum())
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:]
        key = rank * (int(rank.max(initial=0)) + int(after.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """An index of sequences of symbols 1, 2, ...; matches are followed up to ``most`` symbols.

    ``labels`` has a number per sequence; ``least_label`` gives the smallest of all sequences that
    hold a match of ``most`` symbols.
    """

    def __init__(self, sequences: list[np.ndarray], labels: np.ndarray, most: int):
        sizes = np.array([len(s) + 1 for s in sequences])
        text = np.concatenate([x for s in sequences for x in (s, [0])]).astype(np.int64)
        self.n, self.most, self.n_symbols = len(text), most, int(text.max()) + 1
        order = suffix_order(text)
        self.tree = WaveletTree(text[order - 1], self.n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.n_symbols))])
        # Symbols shared with the suffix before, up to ``most``.
        padded = np.concatenate([text, np.zeros(most, np.int64)])
        self.shared, same = np.zeros(self.n + 1, np.int8), np.ones(self.n - 1, bool)
        for k in range(most):
            here = padded[order[1:] + k]
            same &= (here == padded[order[:-1] + k]) & (here != 0)
            self.shared[1:-1] += same
        self._bounds: dict[int, np.ndarray] = {}
        owner = np.repeat(np.asarray(labels, np.int64), sizes)[order]
        self._least = np.minimum.reduceat(owner, self._starts(most)[:-1])

    def _starts(self, depth: int) -> np.ndarray:
        """Where intervals of suffixes that share ``depth`` symbols begin, and the end."""
        if depth not in self._bounds:
            self._bounds[depth] = np.flatnonzero(self.shared < depth)
        return self._bounds[depth]

    def _widen(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray):
        """The interval of the first ``depth`` symbols around each interval."""
        low, high = low.copy(), high.copy()
        for d in np.unique(depth).tolist():
            at = np.flatnonzero(depth == d)
            if d == 0:
                low[at], high[at] = 0, self.n
                continue
            starts = self._starts(d)
            low[at] = starts[np.searchsorted(starts, low[at], "right") - 1]
            high[at] = starts[np.searchsorted(starts, high[at], "left")]
        return low, high

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Backward search: the interval of the symbol in front of what each interval matches."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[: len(low)], self.first[symbol] + both[len(low) :]

    def matching_statistics(self, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For every place of every query the longest match from there, up to ``most``, and where it is.

        All queries are streamed backwards side by side; both results have a row per query and
        are 0 beyond its end. Where the next symbol doesn't fit, the match loses symbols at its
        end until it does. Symbols that the index has not are numbered 0.
        """
        sizes = np.array([len(q) for q in queries])
        width = int(sizes.max(initial=0))
        lengths, places = (np.zeros((len(queries), width), np.int64) for _ in range(2))
        flat = np.concatenate([np.zeros(0, np.int64), *queries]).astype(np.int64)
        ends = np.cumsum(sizes)
        low, high, depth = (np.full(len(queries), v) for v in (0, self.n, 0))
        for t in range(width):
            lanes = np.flatnonzero(sizes > t)
            symbol = flat[ends[lanes] - 1 - t]
            known = (symbol > 0) & (symbol < self.n_symbols)
            gone = lanes[~known]
            low[gone], high[gone], depth[gone] = 0, self.n, 0
            lanes, symbol = lanes[known], symbol[known]
            full = lanes[depth[lanes] == self.most]
            low[full], high[full] = self._widen(low[full], high[full], depth[full] - 1)
            depth[full] -= 1
            todo = np.arange(len(lanes))
            while len(todo):
                at = lanes[todo]
                a, b = self.step(symbol[todo], low[at], high[at])
                fits = (a < b) | (depth[at] == 0)
                ok = at[fits]
                low[ok], high[ok] = a[fits], b[fits]
                depth[ok] += 1
                todo, at = todo[~fits], at[~fits]
                depth[at] = np.maximum(self.shared[low[at]], self.shared[high[at]])
                low[at], high[at] = self._widen(low[at], high[at], depth[at])
            lost = lanes[low[lanes] >= high[lanes]]
            low[lost], high[lost], depth[lost] = 0, self.n, 0
            lanes = np.flatnonzero(sizes > t)
            lengths[lanes, sizes[lanes] - 1 - t] = depth[lanes]
            places[lanes, sizes[lanes] - 1 - t] = low[lanes]
        return lengths, places

    def least_label(self, place: np.ndarray) -> np.ndarray:
        """The smallest label of the sequences that hold the full match found at each place."""
        return self._least[np.searchsorted(self._starts(self.most), place, "right") - 1]
