"""Hashes of words and of runs of words, for many texts at once in numpy.

Words are runs of other bytes than space and 0x09-0x0D, with A-Z in lower case. White space is ASCII,
so bytes do: no byte of a longer character is white space. A word's hash is a sum of random codes of
its bytes times random weights of their places, then mixed: equal for equal words, and as good as
never for others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(20240607)
_ODD = np.uint64(1)
_CODES = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + _ODD
_CODES[65:91] = _CODES[97:123]
_PLACES = 4_096
_WEIGHTS = _RNG.integers(1, 2**63, _PLACES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + _ODD
_STEPS = _RNG.integers(1, 2**63, 16, dtype=np.int64).astype(np.uint64) * np.uint64(2) + _ODD
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
RUN_BYTES = 4_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~_SPACE[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    limits = np.cumsum([len(t) + 1 for t in texts])
    counts = np.bincount(np.searchsorted(limits, start, side="right"), minlength=len(texts))
    if not len(start):
        return np.zeros(0, np.uint64), counts
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    long = size.max() > _PLACES
    value = _WEIGHTS.take(place % _PLACES if long else place)
    if long:
        far = np.flatnonzero(place >= _PLACES)
        value[far] *= mixed((place[far] // _PLACES).astype(np.uint64)) * np.uint64(2) + _ODD
    value *= _CODES.take(data[inside])
    return mixed(np.add.reduceat(value, first)), counts


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``words`` words.

    A text with fewer words has one: all its words. A text without words has none.
    """
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    runs = np.zeros(n, np.uint64)
    for j in range(words):
        runs[: n - j] += hashes[j:] * _STEPS[j]
    runs = mixed(runs)
    out, at = [], 0
    for count in counts.tolist():
        if count >= words:
            out.append(np.unique(runs[at : at + count - words + 1]))
        elif count:
            part = hashes[at : at + count] * _STEPS[:count]
            out.append(mixed(part.sum(keepdims=True) + np.uint64(count)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def set_key(members: np.ndarray) -> int:
    """A 64-bit hash of a set of hashes, as a signed number."""
    total = mixed(members * _STEPS[15] + _STEPS[14]).sum(keepdims=True) + np.uint64(len(members))
    return int(mixed(total).view(np.int64)[0])


def runs_of(texts: list, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into stretches of about ``limit`` bytes."""
    return runs_of_sizes([len(text) for text in texts], limit)


def runs_of_sizes(sizes: list[int], limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts, given their sizes, into stretches of about ``limit`` bytes."""
    begin = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)
