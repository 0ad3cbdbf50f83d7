"""Minimal perfect hashing: n distinct keys to the slots 0..n-1 by hash, bucket and displacement.

Keys are hashed to 64 bits and grouped in buckets. Buckets of two or more keys, the largest first, look for a
displacement that sends their keys to free slots; buckets of one key then store the number of a free slot itself.
A lookup is one hash and one displacement; it tells nothing about keys that were not given, so callers compare the
stored key or fingerprint.
"""

from __future__ import annotations

import numpy as np
import xxhash

MASK = (1 << 64) - 1
MIX, STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
PER_BUCKET = 2
MAX_TRIES = 1 << 20


def hash_keys(keys: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in keys), np.uint64, len(keys))


def place(h: np.ndarray, displacement, n: int) -> np.ndarray:
    """Slots of 64-bit hashes under the displacements of their buckets."""
    x = (h ^ (np.asarray(displacement, np.uint64) * np.uint64(STEP))) * np.uint64(MIX)
    return ((x >> np.uint64(32)) % np.uint64(max(n, 1))).astype(np.int64)


class PerfectHash:
    """`displacement` holds a displacement, or -1 - slot for buckets of one key."""

    def __init__(self, n: int, seed: int, displacement: np.ndarray):
        self.n, self.seed, self.displacement = n, seed, displacement

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        if len(set(keys)) != len(keys):
            raise ValueError("keys must be distinct")
        for seed in range(64):
            h = hash_keys(keys, seed)
            if len(np.unique(h)) == len(h) and (d := _displace(h)) is not None:
                return cls(len(keys), seed, d)
        raise RuntimeError("no perfect hash found")

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slots of many keys, given their hashes under `seed`."""
        if not self.n:
            return np.zeros(len(h), np.int64)
        d = self.displacement[(h % np.uint64(len(self.displacement))).astype(np.int64)]
        return np.where(d < 0, -1 - d, place(h, np.maximum(d, 0), self.n))

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh64_intdigest(key, self.seed)
        d = int(self.displacement[h % len(self.displacement)])
        return -1 - d if d < 0 else (((h ^ (d * STEP & MASK)) * MIX & MASK) >> 32) % self.n


def _displace(h: np.ndarray) -> np.ndarray | None:
    n = len(h)
    buckets = max(1, -(-n // PER_BUCKET))
    displacement = np.zeros(buckets, np.int64)
    if not n:
        return displacement
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, starts, sizes = np.unique(bucket[order], return_index=True, return_counts=True)
    used = np.zeros(n, bool)
    singles = []
    for b in np.argsort(-sizes, kind="stable"):
        members = h[order[starts[b]:starts[b] + sizes[b]]]
        if len(members) == 1:
            singles.append(names[b])
            continue
        tries = 16
        first = 0
        while True:
            tried = np.arange(first, first + tries, dtype=np.uint64)
            at = place(members[None, :], tried[:, None], n)
            good = ~used[at].any(axis=1)
            if len(members) == 2:
                good &= at[:, 0] != at[:, 1]
            else:
                s = np.sort(at, axis=1)
                good &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            if good.any():
                k = int(good.argmax())
                used[at[k]] = True
                displacement[names[b]] = first + k
                break
            first, tries = first + tries, min(4096, tries * 4)
            if first > MAX_TRIES:
                return None
    displacement[singles] = -1 - np.flatnonzero(~used)
    return displacement
