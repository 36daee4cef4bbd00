"""Sketches of shingle sets: one-permutation hashing, made dense, in bands.

One hash function deals the shingles of a text into bins by their top bits, and the smallest hash
of each bin is kept, so a text is hashed once, not once per bin. An empty bin borrows from the bin
that a random order of its own names first among those that are not empty (optimal
densification): two sets agree in a borrowed bin as often as in others, with the probability of
their similarity. Bins are put together in bands; sets that agree in all bins of a band share
that band's bucket.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

from tabvitals.llm.common import mixed

#: Bands and bins in a band. Sets with a similarity of 0.8 miss each other in all bands with a
#: probability of (1 - 0.8 ** 4) ** 32 = 5e-8.
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS  # a power of two
_SHIFT = np.uint64(64 - (BINS - 1).bit_length())


@cache
def lenders() -> np.ndarray:
    """For each bin, the place of each other bin in its order of bins to borrow from."""
    random = np.random.default_rng(20190612)
    orders = np.array([random.permutation(BINS) for _ in range(BINS)])
    return np.argsort(orders, axis=1).astype(np.int16)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The bucket of each band for a sorted set of shingle hashes, which must not be empty."""
    bins = (shingles >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled, least = bins[first], shingles[first]
    if len(filled) < BINS:
        signature = least[lenders()[:, filled].argmin(axis=1)]
        signature[filled] = least
    else:
        signature = least
    rows = signature.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return keys.view(np.int64)


def fingerprint(shingles: np.ndarray) -> bytes:
    """128 bits of a sorted set: equal sets have equal ones."""
    return xxhash.xxh3_128_digest(shingles.tobytes())
