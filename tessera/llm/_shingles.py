"""Word shingles and minimum hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from tessera.llm._common import mix64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: An odd base of polynomial hashes modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def hash_runs(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``units[start:end]`` (any unsigned values)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum((units.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(units)))])
    raw = (total[ends] - total[starts]) * powers(_INVERSE, len(units) + 1)[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles;
    a text of fewer words has its whole sequence as one, a text without words none.

    Words are runs of other than ASCII white space, with A-Z lower-cased.
    """
    n_docs = len(offsets) - 1
    data = _LOWER[data]
    solid = ~_SPACE[data]
    if len(data) == 0:
        return [np.zeros(0, np.uint64)] * n_docs
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    words = hash_runs(data, starts, ends)
    cuts = np.searchsorted(starts, offsets)
    factors = mix64(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    grams = np.zeros(len(words), np.uint64)
    for k in range(size):
        grams[:max(0, len(words) - k)] += words[k:] * factors[k]
    grams = mix64(grams)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        elif b > a:
            short = (words[a:b] * factors[:b - a]).sum(dtype=np.uint64)
            out.append(mix64(np.array([short + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_hashes(values: np.ndarray, starts: np.ndarray, functions: int, seed: int = 1) -> np.ndarray:
    """(runs, functions) least 32-bit hash of each run of ``values`` (64-bit
    hashes; runs begin at ``starts`` and are not empty)."""
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 1 << 32, functions, dtype=np.uint32)
    factors = rng.integers(0, 1 << 31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), functions), np.uint32)
    for first, last in _spans(starts, len(x)):  # a stretch that stays in the cache
        a, b = starts[first], (starts[last] if last < len(starts) else len(x))
        part, at = x[a:b], starts[first:last] - a
        for f in range(functions):
            out[first:last, f] = np.minimum.reduceat((part ^ flips[f]) * factors[f], at)
    return out


def _spans(starts: np.ndarray, n: int, size: int = 1 << 16):
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + size)))
        yield first, last
        first = last


def jaccard_of_items(left: np.ndarray, right: np.ndarray) -> float:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / max(1, len(left) + len(right) - shared)
