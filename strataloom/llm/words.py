"""Words and word shingles of whole texts as 64-bit hashes, for many texts at a time."""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20  # bytes hashed at a time, extended to the next white space
ODD = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of ODD modulo 2^64."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(ODD, len(_powers), 1 << 64))])
    return _powers[:n]


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased, split at ASCII white space) and their number for each text."""
    parts, starts, at = [], [], 0
    space = SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True  # a text always begins a new word
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        if end < len(raw):
            stop = np.flatnonzero(space[end : end + SLICE])
            while not len(stop) and end < len(raw):
                end += SLICE
                stop = np.flatnonzero(space[end : end + SLICE])
            end = min(end + int(stop[0]) if len(stop) else len(raw), len(raw))
        place = np.flatnonzero(~space[at:end]) + at
        if len(place):
            first = np.append(True, np.diff(place) > 1) | edge[place]
            begin = np.flatnonzero(first)
            length = np.diff(np.append(begin, len(place)))
            offset = place - np.repeat(place[begin], length)
            parts.append(mix(np.add.reduceat(BYTE[LOWER[raw[place]]] * powers(int(offset.max()) + 1)[offset], begin)))
            starts.append(place[begin])
        at = end
    if not parts:
        return np.empty(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    begun = np.concatenate(starts)
    return np.concatenate(parts), np.diff(np.searchsorted(begun, bounds))


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one text after the other, and their number.

    A text of fewer words than `size` has its whole sequence as one shingle, a
    text without words has none.
    """
    words, n = word_hashes(raw, bounds)
    text = np.repeat(np.arange(len(n)), n)
    end = np.cumsum(n)
    place = np.arange(len(words))
    left = np.repeat(end, n) - place  # words from here to the end of the text
    takes = np.minimum(np.repeat(n, n), size)
    keep = left >= takes
    keep &= (left == np.repeat(n, n)) | (takes == size)
    total = takes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(size):
        part = np.zeros(len(words), np.uint64)
        inside = i < takes
        inside &= place + i < len(words)
        part[inside] = words[place[inside] + i]
        total += part * np.uint64(pow(ODD, 2 * i + 1, 1 << 64))
    hashes, owner = mix(total[keep]), text[keep]
    counts = np.bincount(owner, minlength=len(n))
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends, strict=True):
        hashes[a:b].sort()
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    return hashes[new], np.bincount(owner[new], minlength=len(n))
