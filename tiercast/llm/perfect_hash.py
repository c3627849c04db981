"""Minimal perfect hash over distinct 64-bit keys, built and read with numpy.

Each level hashes the keys that are left into a bit array of twice their number; a key alone on
its bit keeps it, the others go on. A key's slot is the number of set bits before its own, over all
levels. A few bits per key, constant expected time.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
SPARSENESS = 2
MOST_LEVELS = 64


def hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def hash_bit(key: int, level: int, n_bits: int) -> int:
    """The place of one key among the bits of a level."""
    return int(hashed(np.array([key], np.int64), level)[0]) % n_bits


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, MOST_LEVELS) >> _U(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, words: np.ndarray, sizes: np.ndarray) -> None:
        """``words``: the bits of all levels, in 64-bit words; ``sizes``: words of each level."""
        self.words, self.sizes = words, sizes
        self._firsts = np.cumsum(sizes) - sizes
        set_bits = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(set_bits) - set_bits

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, words = keys, []
        while len(left):
            if len(words) == MOST_LEVELS:
                raise ValueError("the keys are not distinct")
            n_words = -(-SPARSENESS * len(left) // 64)
            bit = hashed(left, len(words)) % _U(64 * n_words)
            alone = np.bincount(bit.astype(np.int64), minlength=64 * n_words) == 1
            bits = alone.reshape(n_words, 64)
            words.append(np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel())
            left = left[~alone[bit.astype(np.int64)]]
        sizes = np.array([len(level) for level in words], np.int64)
        return cls(np.concatenate([*words, np.empty(0, np.uint64)]).astype(np.uint64), sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1, or any slot, for keys that were not given to ``build``."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (first, size) in enumerate(zip(self._firsts, self.sizes)):
            bit = hashed(keys[open_], level) % _U(64 * int(size))
            word = first + (bit >> _U(6)).astype(np.int64)
            place = bit & _U(63)
            here = (self.words[word] >> place) & _U(1) == 1
            below = self.words[word] & ((_U(1) << place) - _U(1))
            slot = self.before[word] + np.bitwise_count(below)
            found[open_[here]] = slot[here]
            open_ = open_[~here]
        return found
