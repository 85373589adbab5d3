"""Word shingles of whole texts as sets of 64-bit hashes, vectorised over many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from velolake.llm.common import BYTE_CODES, mixed, powers

WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[9:14] = True
_SPACE[32] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_CODES = BYTE_CODES[_LOWER]


def hashed_words(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that stand one after the other: hash, start and length of every word, and the number of words before each text.

    `codes` has a number per byte value, `space` marks the byte values between words.
    """
    inside = ~space[data]
    starting = inside.copy()
    starting[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < offsets[1:]]
    starting[bounds] = inside[bounds]  # a text ends a word
    starts = np.flatnonzero(starting)
    if not len(starts):
        return np.empty(0, np.uint64), starts, starts, np.zeros(len(offsets), np.int64)
    place = np.flatnonzero(inside)
    first = np.searchsorted(place, starts)
    lengths = np.diff(np.append(first, len(place)))
    position = np.arange(len(place)) - np.repeat(first, lengths)
    sums = np.add.reduceat(codes[data[place]] * powers(int(lengths.max()))[position], first)
    return mixed(sums + lengths.astype(np.uint64)), starts, lengths, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray = LOWER_CODES) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of texts that stand one after the other, A-Z as a-z unless `codes` differ, and the number of words before each text."""
    hashes, _, _, counts = hashed_words(data, offsets, codes, _SPACE)
    return hashes, counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of `words` words.

    A text with fewer words has one, of all of them; a text without words has none.
    """
    hashes, counts = word_hashes(data, offsets)
    run = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for factor, k in zip(powers(words + 1)[1:], range(words), strict=True):
        run += hashes[k:k + len(run)] * factor
    run = mixed(run)
    for first, end in zip(counts[:-1], counts[1:], strict=True):
        if end - first >= words:
            yield np.unique(run[first:end - words + 1])
        elif end > first:
            few = (hashes[first:end] * powers(words + 1)[1:end - first + 1]).sum(dtype=np.uint64, keepdims=True)
            yield mixed(few + powers(words + 1)[end - first:end - first + 1])
        else:
            yield np.empty(0, np.uint64)
