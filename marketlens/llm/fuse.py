"""A static 3-wise binary fuse filter (Graf and Lemire, 2022) in numpy.

It holds a fixed set of 64-bit keys in about nine bits each and answers "maybe in the set" with no
false negative and about 1/256 false positives. Keys are placed by peeling: slots that only one key
uses are emptied round by round, and values are filled in backwards.
"""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QQQ")  # seed, segment length, number of segments
_TRIES = 100


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _places(hashes: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments."""
    first = ((hashes >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((hashes >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (hashes & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of these keys, repeats counted once."""
    keys = np.unique(keys)
    n = len(keys)
    length = 1 << min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / length) - 2)
    for seed in range(1, _TRIES):
        hashes = _mixed(keys, seed * 0x9E3779B97F4A7C15 % 2**64)
        table = _filled(_places(hashes, length, segments), _prints(hashes), (segments + 2) * length)
        if table is not None:
            return _HEAD.pack(seed, length, segments) + table.tobytes()
        segments += 1
    raise RuntimeError("no seed places these keys")


def _filled(places: np.ndarray, prints: np.ndarray, size: int) -> np.ndarray | None:
    n = places.shape[1]
    uses = np.bincount(places.ravel(), minlength=size)
    # Exact in doubles: a sum of key numbers stays under 2**53.
    owner = np.bincount(places.ravel(), np.tile(np.arange(n, dtype=float), 3), size).astype(np.int64)
    rounds, left = [], n
    ready = np.flatnonzero(uses == 1)
    while len(ready):
        who, at = np.unique(owner[ready], return_index=True)
        rounds.append((who, ready[at]))
        left -= len(who)
        gone = places[:, who].ravel()
        np.subtract.at(uses, gone, 1)
        np.subtract.at(owner, gone, np.tile(who, 3))
        touched = np.unique(gone)
        ready = touched[uses[touched] == 1]
    if left:
        return None
    table = np.zeros(size, np.uint8)
    for who, slot in reversed(rounds):
        others = np.bitwise_xor.reduce(table[places[:, who]], axis=0) ^ table[slot]
        table[slot] = prints[who] ^ others
    return table


def maybe_in(data: bytes, keys: np.ndarray) -> np.ndarray:
    """For each key: false if it is surely not in the filter."""
    seed, length, segments = _HEAD.unpack_from(data)
    table = np.frombuffer(data, np.uint8, offset=_HEAD.size)
    hashes = _mixed(keys, seed * 0x9E3779B97F4A7C15 % 2**64)
    found = np.bitwise_xor.reduce(table[_places(hashes, length, segments)], axis=0)
    return found == _prints(hashes)
