"""A static binary-fuse filter (three-wise, 8-bit fingerprints) in numpy.

After the published construction: keys map to three slots in neighbouring
segments, slots that hold one key are peeled round by round, and fingerprints
are assigned in the reverse order. There are no false negatives; about 1 key in
256 that was never added is let through.
"""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QIII")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = ((h >> np.uint64(32)) * np.uint64(segments * segment) >> np.uint64(32)).astype(np.int64)
    low = h.astype(np.int64)
    return first, (first + segment) ^ ((low >> 18) & (segment - 1)), (first + 2 * segment) ^ (low & (segment - 1))


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """A filter over the distinct 64-bit ``keys``; none gives a filter that lets nothing through."""
    keys = np.unique(np.asarray(keys).astype(np.uint64))
    n = len(keys)
    if not n:
        return _HEAD.pack(0, 0, 0, 0)
    segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25))) if n > 1 else 4
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    for attempt in range(64):
        segments = max(1, -(-int(n * factor * (1 + attempt // 8 / 10)) // segment) - 2)
        seed = (0x9E3779B97F4A7C15 * (attempt + 1)) & (2**64 - 1)
        h = _mix(keys, seed)
        at = np.stack(_slots(h, segment, segments))
        size = (segments + 2) * segment
        count = np.bincount(at.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the numbers of the keys in a slot
        for row in at:
            np.bitwise_xor.at(held, row, np.arange(n))
        peeled: list[tuple[np.ndarray, np.ndarray]] = []
        left, open_slots = n, np.flatnonzero(count == 1)
        while len(open_slots):
            who, place = np.unique(held[open_slots], return_index=True)
            peeled.append((who, open_slots[place]))
            left -= len(who)
            touched = at[:, who]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(held, row, who)
            open_slots = np.unique(touched)
            open_slots = open_slots[count[open_slots] == 1]
        if not left:
            break
    else:
        raise ValueError("no filter was found; are the keys 64-bit hashes?")
    table, prints = np.zeros(size, np.uint8), _prints(h)
    for who, place in reversed(peeled):
        table[place] = prints[who] ^ table[at[0, who]] ^ table[at[1, who]] ^ table[at[2, who]]
    return _HEAD.pack(seed, segment, segments, n) + table.tobytes()


def contains(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key that was added, and for about 1 in 256 of the others."""
    seed, segment, segments, n = _HEAD.unpack_from(filter_)
    keys = np.asarray(keys).astype(np.uint64)
    if not n:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_, np.uint8, offset=_HEAD.size)
    h = _mix(keys, seed)
    a, b, c = _slots(h, segment, segments)
    return _prints(h) == table[a] ^ table[b] ^ table[c]
