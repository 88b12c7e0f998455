"""Words of many texts at once: spans, hashes and n-gram hashes as numpy arrays.

A word is a run of bytes outside a set of separators; the separators are ASCII, so a
multi-byte character is never cut.  A batch is cut into blocks of whole texts, which bounds
the memory by the block (or the longest text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once.
BLOCK_BYTES = 1 << 21

U64 = np.uint64


def _separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Space and U+0009 to U+000D.
BLANKS = _separators(b" \t\n\x0b\x0c\r")
#: Every ASCII character that is neither a letter nor a digit.
NOT_ALNUM = _separators(bytes(c for c in range(128) if not chr(c).isalnum()))

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEPS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of the texts of one block, in order."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text begins in data, one more than texts
    starts: np.ndarray  # where each word begins and ends
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        if not len(self.starts):
            return np.zeros(0, U64)
        base = _BASES[seed]
        powers = np.full(n, base, U64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(n + 1, U64)
        own = sums[1:]  # in place: arrays of eight bytes for each byte of text are what a worker's memory goes to
        np.add(self.data, U64(1), out=own, dtype=U64)
        own *= powers
        np.cumsum(own, out=own)
        powers[:] = pow(base, -1, 1 << 64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        value = (sums[self.ends] - sums[self.starts]) * powers[self.starts]
        return mix(value + (self.ends - self.starts).astype(U64) * U64(_STEPS[seed]))

    def room(self) -> np.ndarray:
        """Words from each word to its text's end, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def ngrams(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each position on; positions without room are left out at the end only."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    step = U64(_STEPS[seed])
    total, done = None, 0
    block, width = hashes, 1  # hash of `width` words from each position
    while width <= size:
        if size & width:
            part = block[done : done + n]
            total = part.copy() if total is None else mix(total * step + part)
            done += width
        if width * 2 <= size:
            block = mix(block[:-width] * step + block[width:] + U64(width))
        width *= 2
    return total


def find(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS) -> Words:
    """The words of the texts that lie at ``offsets`` in ``data``."""
    n = len(data)
    inside = ~separators[data]
    edge = offsets[offsets < n]
    before = np.empty(n, bool)
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    if n:
        after[n - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, separators: np.ndarray = BLANKS) -> Iterator[tuple[int, int, Words]]:
    """``(begin, end, words)`` for runs of rows of about ``BLOCK_BYTES``."""
    data, offsets = raw(column)
    begin, n = 0, len(column)
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + BLOCK_BYTES, "right")) - 1
        end = min(n, max(end, begin + 1))
        low, high = offsets[begin], offsets[end]
        yield begin, end, find(data[low:high], offsets[begin : end + 1] - low, separators)
        begin = end
