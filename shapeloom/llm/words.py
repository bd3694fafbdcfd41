"""Words and word n-grams of many texts at once, as 64-bit hashes.

Words are runs of bytes other than ASCII white space. A word's hash is a
polynomial of its bytes, an n-gram's a mix of its words' hashes, both modulo 2**64.
"""

from __future__ import annotations

import numpy as np

from shapeloom.llm.common import mix

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(n - 1, 1).bit_length()
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word; no word crosses a text's border."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    before[borders] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[borders[borders > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)
    values *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, first))


def word_ngrams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram hashes of every text in order, and where each text's begin.

    A text of fewer than n words, but at least one, has one n-gram of all its words.
    """
    starts, ends = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.append(0, np.cumsum(grams))
    total = int(at[-1])
    owner = np.repeat(np.arange(len(counts)), grams)
    place = first[owner] + np.arange(total) - at[owner]
    size = np.minimum(counts, n)[owner]
    out = np.zeros(total, np.uint64)
    for j in range(n):
        has = size > j
        out[has] = mix(out[has] * _BASE + words[place[has] + j] + np.uint64(j + 1))
    return out, at


def distinct_sorted(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values, sorted and without repeats, and where each text's begin."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[keep], minlength=len(at) - 1)
    return values[keep], np.append(0, np.cumsum(counts))
