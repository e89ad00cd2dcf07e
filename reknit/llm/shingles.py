"""Word shingles as sets of 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import numpy as np
import xxhash

# Words whose hash a worker remembers before it starts anew.
REMEMBERED = 250_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """The hash of a word, computed once per worker for as long as it is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads neighbouring values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX2
    return values ^ (values >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and \\t to \\r, with A-Z in lower case.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, which is just that rule.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """The distinct hashed shingles, sorted; fewer words than ``size`` make one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    width = min(size, len(words))
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    count = len(words) - width + 1
    rolled = np.zeros(count, np.uint64)
    for place in range(width):
        rolled = mixed((rolled + codes[place:place + count]) * _MIX)
    # A short text's only shingle must differ from a shingle of another width.
    return np.unique(mixed(rolled + np.uint64(width)))


def permutations(count: int, seed: int = 1) -> np.ndarray:
    """Odd multipliers, one per hash function."""
    draw = np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64)
    return draw * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest 32-bit hash of a set under every hash function."""
    lowest = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(shingles), 512):
        block = shingles[start:start + 512, None] * multipliers[None, :]
        lowest = np.minimum(lowest, (block >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return lowest
