"""XXH64 of many byte ranges at once, in numpy: the public XXH64 algorithm, a range a lane."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
#: Fixed values of XXH64.
P1, P2, P3, P4, P5 = U(11400714785074694791), U(14029467366897019727), U(1609587929392839161), U(9650029242287828579), U(2870177450012600261)
#: Longer ranges are hashed one by one.
LONG = 160


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def _same_length(words: np.ndarray, raw: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the ranges of ``n`` bytes that start at ``at``; words: the 8 bytes from each position."""
    pos, s = 0, U(seed)
    if n >= 32:
        lanes = [np.full(len(at), v) for v in (s + P1 + P2, s + P2, s, s - P1)]
        while pos + 32 <= n:
            lanes = [_rotl(v + words[at + (pos + 8 * k)] * P2, 31) * P1 for k, v in enumerate(lanes)]
            pos += 32
        h = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
        for v in lanes:
            h = (h ^ (_rotl(v * P2, 31) * P1)) * P1 + P4
    else:
        h = np.full(len(at), s + P5)
    h = h + U(n)
    while pos + 8 <= n:
        h = _rotl(h ^ (_rotl(words[at + pos] * P2, 31) * P1), 27) * P1 + P4
        pos += 8
    if pos + 4 <= n:
        h = _rotl(h ^ ((words[at + pos] & U(0xFFFFFFFF)) * P1), 23) * P2 + P3
        pos += 4
    while pos < n:
        h = _rotl(h ^ (raw[at + pos].astype(U) * P5), 11) * P1
        pos += 1
    h = (h ^ (h >> U(33))) * P2
    h = (h ^ (h >> U(29))) * P3
    return h ^ (h >> U(32))


def xxh64(raw: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """The XXH64 (uint64) of each range ``raw[start : start + length]``."""
    out = np.empty(len(start), dtype=U)
    if not len(start):
        return out
    padded = np.concatenate([raw, np.zeros(16, dtype=np.uint8)])
    words = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (len(raw) + 8, 8), (1, 1))).view("<u8").ravel()
    order = np.argsort(length.astype(np.uint16) if int(length.max()) < 65536 else length, kind="stable")
    sorted_length = length[order]
    first = np.concatenate([[0], np.nonzero(np.diff(sorted_length))[0] + 1, [len(order)]])
    with np.errstate(over="ignore"):
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            n, own = int(sorted_length[lo]), order[lo:hi]
            if n > LONG:
                out[own] = [xxhash.xxh64_intdigest(raw[a : a + n].tobytes(), seed) for a in start[own]]
            else:
                out[own] = _same_length(words, padded, start[own], n, seed)
    return out
