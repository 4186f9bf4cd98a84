"""64-bit hashes of words and of runs of words, for whole texts at once in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Powers:
    """Powers of an odd number mod 2^64, as many as the longest text so far needs."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 1 << 16), self.base)
            self.values = np.concatenate((np.ones(1, dtype=np.uint64), np.cumprod(steps, dtype=np.uint64)))
        return self.values[:n]


_UP, _DOWN = _Powers(STEP), _Powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of every number."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def joined_words(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of UTF-8 text joined by one space, and where each begins and ends."""
    parts = data.split()
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    return b" ".join(parts), begins, begins + lengths


def word_hashes(data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, wherever it stands: prefix sums of powers, shifted back."""
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(raw * _UP.upto(len(raw)), dtype=np.uint64)))
    return mix((sums[ends] - sums[begins]) * _DOWN.upto(len(raw) + 1)[begins])


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words."""
    runs = np.zeros(len(words) - length + 1, dtype=np.uint64)
    for k in range(length):
        runs = runs * STEP + words[k : len(words) - length + 1 + k]
    return mix(runs)


def signed(data: bytes, size: int = 8) -> list[int]:
    """The digest of bytes as signed 64-bit numbers, one per 8 bytes of size."""
    digest = hashlib.blake2b(data, digest_size=size).digest()
    return [int.from_bytes(digest[i : i + 8], "little", signed=True) for i in range(0, size, 8)]
