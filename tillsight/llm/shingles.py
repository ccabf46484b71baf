"""Sets of word shingles as 64-bit numbers, computed for many texts at once over their bytes.

Letters A-Z count as a-z; words are runs of bytes other than space and tab to carriage return. UTF-8 keeps those
bytes out of longer characters, so working on bytes equals working on characters.
"""

from __future__ import annotations

import numpy as np

_SEED = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _SEED.integers(0, 1 << 64, 256, dtype=np.uint64)  # a random number per byte
for _b in range(65, 91):
    _BYTE[_b] = _BYTE[_b + 32]
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread every bit over the whole number; different salts give independent orders."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


class Shingler:
    """Shingle sets of `words` words; a shorter text is one shingle of all its words."""

    def __init__(self, words: int):
        self.words = words
        self._up, self._down = _powers(_BASE, 0), _powers(_BACK, 0)

    def words_of(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each word in a run of bytes."""
        if len(raw) > len(self._up):
            self._up, self._down = _powers(_BASE, len(raw)), _powers(_BACK, len(raw))
        word = ~_GAP[raw]
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return np.zeros(0, np.uint64), starts, ends
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            np.where(word, _BYTE[raw], np.uint64(0)) * self._up[:len(raw)], dtype=np.uint64)])
        return mix((sums[ends] - sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64)), starts, ends

    def sequences(self, texts: list[bytes]) -> list[np.ndarray]:
        """The shingles of each text in order."""
        hashes, starts, _ = self.words_of(np.frombuffer(b" ".join([*texts, b""]), np.uint8))
        limits = np.cumsum([len(t) + 1 for t in texts])
        upto = np.searchsorted(starts, limits)
        k = self.words
        run = np.full(max(0, len(hashes) - k + 1), k, np.uint64)
        for i in range(k):
            run = mix(run + hashes[i:i + len(run)], i + 1)
        out, low = [], 0
        for high in upto:
            n = high - low
            if n >= k:
                out.append(run[low:high - k + 1])
            elif n:
                one = np.full(1, n, np.uint64)
                for i in range(n):
                    one = mix(one + hashes[low + i:low + i + 1], i + 1)
                out.append(one)
            else:
                out.append(np.zeros(0, np.uint64))
            low = high
        return out

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The distinct shingles of each text, ascending."""
        return [np.unique(s) for s in self.sequences(texts)]


def name_of(values: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit digests of a set."""
    parts = np.array([np.bitwise_xor.reduce(mix(values, 11)), np.add.reduce(mix(values, 23))], np.uint64)
    first = mix(parts[:1] + parts[1:] * np.uint64(3) + np.uint64(len(values)), 5)
    return int(first.view(np.int64)[0]), int(parts.view(np.int64)[1])
