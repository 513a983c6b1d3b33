"""Words and word shingles of many texts at once, as 64-bit hashes.

Words are runs of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``. A word's
hash is a sum of table values times powers of an odd number, taken from running
sums over the whole batch and then mixed; a shingle's is a mixed sum of its
words' hashes times odd numbers. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
K = 5
_CHUNK = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly; one to one."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = mix(np.arange(1, K + 1, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, U64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one byte of each word; texts lie end to end in ``data``."""
    inside = ~BLANK[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes = np.empty(len(starts), U64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + _CHUNK, side="right")))
        size = int(ends[last - 1] - origin)
        power, inverse = _power_tables(size + 1)
        sums = np.zeros(size + 1, U64)
        np.cumsum(_BYTES[data[origin : origin + size]] * power[:size], out=sums[1:])
        begin, end = starts[first:last] - origin, ends[first:last] - origin
        hashes[first:last] = (sums[end] - sums[begin]) * inverse[begin]
        first = last
    return mix(hashes)


class Words:
    """Words of a run of texts: ``counts`` and ``bounds`` per text, a hash per word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        self.starts, self.ends = word_spans(data, offsets)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    def windows(self) -> np.ndarray:
        """Hash of the K words from each word on, whichever texts they are of."""
        n = max(0, len(self.hashes) - K + 1)
        sums = np.zeros(n, U64)
        for i in range(K):
            sums += self.hashes[i : i + n] * _PLACES[i]
        return mix(sums)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text, sorted, end to end, and where each text's begin.

        A text of fewer than K words is one shingle, one without words has none.
        """
        windows, sets = self.windows(), []
        for begin, count in zip(self.bounds[:-1].tolist(), self.counts.tolist()):
            if count >= K:
                found = windows[begin : begin + count - K + 1].copy()
                found.sort()
                if len(found) > 1:
                    fresh = np.empty(len(found), bool)
                    fresh[0] = True
                    np.not_equal(found[1:], found[:-1], out=fresh[1:])
                    found = found[fresh]
            elif count:
                short = self.hashes[begin : begin + count] * _PLACES[:count]
                found = mix(short.sum(dtype=U64, keepdims=True) ^ U64(count))
            else:
                found = windows[:0]
            sets.append(found)
        bounds = np.zeros(len(sets) + 1, np.int64)
        np.cumsum([len(x) for x in sets], out=bounds[1:])
        return (np.concatenate(sets) if sets else np.zeros(0, U64)), bounds

    def repeated(self) -> np.ndarray:
        """Per text, how many words lie in windows that occur twice or more in it."""
        windows = self.windows()
        totals = np.zeros(len(self.counts), np.int64)
        for text, (begin, count) in enumerate(zip(self.bounds[:-1].tolist(), self.counts.tolist())):
            if count <= K:
                continue
            own = windows[begin : begin + count - K + 1]
            order = np.sort(own)
            twice = order[1:][order[1:] == order[:-1]]
            if len(twice):
                at = np.flatnonzero(np.isin(own, twice))
                covered = np.zeros(count + 1, np.int64)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + K, -1)
                totals[text] = int((np.cumsum(covered)[:-1] > 0).sum())
        return totals
