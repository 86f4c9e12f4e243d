"""Word shingles and MinHash signatures of a batch of texts, vectorised over its UTF-8 bytes.

Words are runs of bytes other than space and the controls 9 to 13, with A-Z lower-cased. A text's
set holds its distinct shingles of k words; with fewer words, the whole sequence is its one shingle.
Shingles are 64-bit hashes; all arithmetic on them wraps.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from marquetry.llm.common import utf8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(2)
def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _power_table(n: int, base: int) -> np.ndarray:
    """The first n powers, from a table whose size is a power of two."""
    return _powers(1 << max(12, (n - 1).bit_length()), base)[:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    data, offsets = utf8(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    dark = ~_WHITE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    before = np.concatenate([[False], dark[:-1]])
    starts = np.flatnonzero(dark & (~before | opens[:-1]))
    after = np.concatenate([dark[1:], [False]])
    ends = np.flatnonzero(dark & (~after | opens[1:])) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power_table(len(data), _BASE), out=sums[1:])
    back = _power_table(len(data), pow(_BASE, -1, 1 << 64))
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_hashes(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order (repeats included), and the number of each text's."""
    words, sizes = word_hashes(texts)
    if not len(words):
        return words, sizes
    stops = np.cumsum(sizes)
    left = np.repeat(stops, sizes) - np.arange(len(words))  # words from here to the text's end
    total = np.minimum(np.repeat(sizes, sizes), k).astype(np.uint64)
    sums = total * np.uint64(0xA0761D6478BD642F)
    for j in range(k):
        rest = len(words) - j
        if rest > 0:
            sums[:rest] += np.where(left[:rest] > j, words[j:] * np.uint64(pow(_BASE, 2 * j + 1, 1 << 64)), np.uint64(0))
    first = np.zeros(len(words), bool)
    first[(stops - sizes)[sizes > 0]] = True
    return mix(sums[(left >= k) | first]), np.where(sizes > 0, np.maximum(sizes - k + 1, 1), 0)


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, joined in order, and each set's size."""
    hashes, sizes = shingle_hashes(texts, k)
    ends = np.cumsum(sizes)
    for begin, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        hashes[begin:end].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    counted = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], counted[ends] - counted[ends - sizes]


@lru_cache(4)
def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of n universal hashes x -> a * x + b, each a permutation of 64-bit words."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 1 << 64, (2, n), dtype=np.uint64)
    return a | np.uint64(1), b


def signatures(hashes: np.ndarray, sizes: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """For each text the least value of each permutation over its shingles, mixed; all ones where it has none."""
    out = np.full((len(sizes), n), _WRAP, np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        least = np.empty((n, len(full)), np.uint64)
        row = np.empty(len(hashes), np.uint64)
        for k, (a, b) in enumerate(zip(*permutations(n, seed), strict=True)):
            np.multiply(hashes, a, out=row)
            row += b
            np.minimum.reduceat(row, starts, out=least[k])
        out[full] = mix(least.T)
    return out
