"""Word shingles of whole texts as 64-bit hashes, a chunk of text at a time."""

from __future__ import annotations

import numpy as np

from tidefeed.llm.shared import Rolling, mixed

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = 0xC2B2AE3D27D4EB4F


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of words of each text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    data = _LOWER[data]
    space = _SPACE[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = space[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(~space & edge[:-1])
    edge[1:-1] = space[1:]
    edge[offsets] = True
    ends = np.flatnonzero(~space & edge[1:]) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return Rolling(data).ranges(starts, ends), counts


def shingles(
    data: np.ndarray, offsets: np.ndarray, width: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and how many each has.

    A text of fewer than ``width`` words is one shingle, a text without words has none.
    """
    hashes, n_words = words(data, offsets)
    first = np.concatenate([[0], np.cumsum(n_words)])
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    value = np.zeros(len(hashes), np.uint64)
    for i in range(width):
        value += padded[i : i + len(hashes)] * np.uint64(pow(_STEP, i, 1 << 64))
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        at = first[i]
        value[at] = sum(
            int(hashes[at + k]) * pow(_STEP, k, 1 << 64) for k in range(int(n_words[i]))
        ) & ((1 << 64) - 1)
    value = mixed(value)
    n = np.where(n_words < width, np.minimum(n_words, 1), n_words - width + 1)
    whole = np.arange(len(hashes)) - np.repeat(first[:-1], n_words) < np.repeat(n, n_words)
    value = value[whole]
    bounds = np.concatenate([[0], np.cumsum(n)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[bounds[:-1][n > 0]] = True
    sizes = np.diff(np.concatenate([[0], np.cumsum(new)])[bounds])
    return value[new], sizes
