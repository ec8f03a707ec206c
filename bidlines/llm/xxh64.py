"""XXH64 of many byte ranges of one buffer at once."""

from __future__ import annotations

import numpy as np

P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """Hashes of ``data[start : start + length]``; ``data`` (uint8) must hold 8 more bytes than any range needs."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = lambda kind: np.ndarray(len(data) - 8, kind, data, strides=(1,))  # noqa: E731  a value at every byte
    u64, u32 = at("<u8"), at("<u4")
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(starts), seed + P5)
        at_, left = starts.astype(np.int64), lengths.astype(np.int64)
        long = np.flatnonzero(left >= 32)
        if len(long):
            acc = [np.full(len(long), s) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            p, stripes = at_[long], left[long] // 32
            live = np.arange(len(long))
            for k in range(int(stripes.max())):
                live = live[stripes[live] > k]
                for i in range(4):
                    acc[i][live] = _round(acc[i][live], u64[p[live] + 32 * k + 8 * i])
            x = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                x = (x ^ _round(np.zeros_like(a), a)) * P1 + P4
            h[long] = x
            at_ = at_.copy()
            at_[long] += 32 * stripes
            left = left & 31
        h += lengths.astype(np.uint64)
        for k in range(3):
            m = np.flatnonzero(left >= 8 * (k + 1))
            if len(m):
                h[m] = _rotl(h[m] ^ _round(np.zeros(len(m), np.uint64), u64[at_[m] + 8 * k]), 27) * P1 + P4
        at_, left = at_ + (left & ~7), left & 7
        m = np.flatnonzero(left >= 4)
        h[m] = _rotl(h[m] ^ (u32[at_[m]].astype(np.uint64) * P1), 23) * P2 + P3
        at_, left = at_ + (left & 4), left & 3
        for k in range(3):
            m = np.flatnonzero(left > k)
            h[m] = _rotl(h[m] ^ (data[at_[m] + k].astype(np.uint64) * P5), 11) * P1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        return h ^ (h >> np.uint64(32))
