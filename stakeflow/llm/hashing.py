"""Vectorised 64-bit hashes of words and of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    digest = xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(w) for w in words]), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n or more of each; one table of either is kept, and grows."""
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


class Runs:
    """Hashes of any runs of a sequence of word hashes; equal runs have equal hashes wherever they stand."""

    def __init__(self, hashes: np.ndarray):
        up, self.inverse = powers(len(hashes) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)))

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def all_of(self, n: int) -> np.ndarray:
        """The hashes of all runs of n words."""
        m = len(self.sums) - n
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:m]) * self.inverse[:m] + np.uint64(n))


def text_key(words: list[bytes]) -> bytes | None:
    """128 bits that stand for a sequence of words; None for no words."""
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None
