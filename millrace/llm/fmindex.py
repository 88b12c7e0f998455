"""A compressed full-text index over sequences of symbols, queried for many patterns at once."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A packed bit sequence with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int32)]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many ones lie before each position."""
        word = at >> 6
        mask = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int32)


class WaveletMatrix:
    """The symbols' bits, level by level, each level stably sorted by the bit above it."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(width)):
            bits = (symbols >> shift) & 1
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` lands among the occurrences of ``symbol`` on the last level."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, ones + zeros, at - ones)
        return at


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling; a suffix precedes its extensions."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while True:
        key = rank * (n + 2)
        key[:-width] += rank[width:] if width < n else 0
        order = np.argsort(key)
        ordered = key[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        rank[order] = np.cumsum(fresh)
        if fresh.all() or width >= n:
            return order
        width *= 2


class FMIndex:
    """Backward search over sequences, restricted to sequences of lower owners.

    ``sequences`` are arrays of 64-bit symbols; ``owners`` rank the document of each.
    """

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        flat = np.concatenate(sequences)
        self.alphabet, codes = np.unique(flat, return_inverse=True)
        n = int((lengths + 1).sum())
        self.text = np.zeros(n, np.int64)  # 0 ends a sequence
        inside = np.ones(n, bool)
        inside[self.starts + lengths] = False
        self.text[inside] = codes + 1
        order = suffix_array(self.text)
        last = self.text[order - 1]  # the symbol before each suffix
        count = len(self.alphabet) + 1
        self.below = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=count))])[:-1]
        self.matrix = WaveletMatrix(last, max(1, int(count - 1).bit_length()))
        every = np.arange(count)
        self.base = self.matrix.descend(every, np.zeros(count, np.int32))
        self.n = n
        # The lowest owner in any interval of suffixes: minima over blocks of doubling size.
        owner = np.repeat(owners, lengths + 1)[order].astype(np.int32)
        self.lowest = [owner]
        width = 1
        while 2 * width <= n:
            row = self.lowest[-1]
            self.lowest.append(np.minimum(row[: len(row) - width], row[width:]))
            width *= 2

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int32)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.lowest[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out

    def matching(self, sequence: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Matching statistics: how many symbols up to and with ``end`` occur in a sequence of an owner below ``owner``.

        ``sequence`` numbers the indexed sequences that the queries are taken from.
        """
        start = self.starts[sequence]
        length = np.zeros(len(end), np.int64)
        live = np.arange(len(end))
        at = start + end
        low, high = np.zeros(len(end), np.int32), np.full(len(end), self.n, np.int32)
        while len(live):
            symbol = self.text[at]
            shift = (self.below[symbol] - self.base[symbol]).astype(np.int32)
            both = self.matrix.descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = both[: len(live)] + shift, both[len(live) :] + shift
            good = np.flatnonzero(high > low)
            good = good[self._least(low[good], high[good]) < owner[live[good]]]
            length[live[good]] += 1
            at = at[good] - 1
            live, low, high = live[good], low[good], high[good]
            more = np.flatnonzero(at >= start[live])
            at, live, low, high = at[more], live[more], low[more], high[more]
        return length


def covered_intervals(index: FMIndex, lengths: np.ndarray, owners: np.ndarray, window: int) -> list[np.ndarray]:
    """``(sequence, begin, end)`` arrays of the parts whose every ``window`` symbols occur in a lower owner's sequence.

    The ends of windows not yet decided form ranges.  A long match at a range's last end decides
    all the ends it spans; a short one at the first end rules out those whose window would contain
    it; where the first matches and the last does not, the middle is tried.
    """
    sequence = np.flatnonzero(lengths >= window)
    first, last = np.full(len(sequence), window - 1), lengths[sequence] - 1
    found: list[np.ndarray] = []

    def measure(seq, end):
        return index.matching(seq, end, owners[seq])

    def report(seq, end, size):
        good = size >= window
        found.append(np.stack([seq[good], end[good] - size[good] + 1, end[good] + 1]))

    while len(sequence):
        n = len(sequence)
        sizes = measure(np.concatenate([sequence, sequence]), np.concatenate([first, last]))
        head, tail = sizes[:n], sizes[n:]
        report(sequence, first, head)
        report(sequence, last, tail)
        next_first = np.where(head >= window, first + 1, first + window - head)
        next_last = np.where(tail >= window, last - tail + window - 1, last - 1)
        ranges = [(sequence, next_first, next_last)]
        split = np.flatnonzero((head >= window) & (tail < window) & (next_last - next_first > 2))
        if len(split):
            seq, a, b = sequence[split], next_first[split], next_last[split]
            middle = (a + b) // 2
            size = measure(seq, middle)
            report(seq, middle, size)
            hit = size >= window
            whole = np.ones(n, bool)
            whole[split] = False
            ranges = [
                tuple(x[whole] for x in ranges[0]),
                (seq, a, np.where(hit, np.minimum(middle - 1, middle - size + window - 1), middle - 1)),
                (seq, np.where(hit, middle + 1, middle + window - size), b),
            ]
        sequence, first, last = (np.concatenate(x) for x in zip(*ranges))
        open_ = first <= last
        sequence, first, last = sequence[open_], first[open_], last[open_]
    return found
