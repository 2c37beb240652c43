"""A cuckoo filter over 64-bit hashes, worked on in whole arrays."""

from __future__ import annotations

import numpy as np

SLOTS = 4
ROUNDS = 400


class Full(Exception):
    """No place was found; the filter needs twice the buckets."""


class CuckooFilter:
    """16-bit fingerprints, four to a bucket, each in one of two buckets.

    The second bucket follows from the first and the fingerprint, so a resident can be moved
    without its key. Equal fingerprints may be held several times, which lets ``count`` tell
    one insertion from two and ``remove`` take back exactly one.
    """

    def __init__(self, buckets: int):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, n) / (0.7 * SLOTS))))))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        made = cls(1)
        made.table = np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy()
        return made

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bucket and fingerprint of each hash; 0 marks a free slot."""
        h = hashes.astype(np.int64).view(np.uint64)
        prints = (h >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return (h & np.uint64(len(self.table) - 1)).astype(np.int64), prints

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        mixed = prints.astype(np.int64) * 0x5BD1E995
        return bucket ^ ((mixed >> 7) & (len(self.table) - 1))

    def insert(self, hashes: np.ndarray) -> None:
        """Add each hash once. Raises ``Full`` and leaves the filter as it was if they don't fit."""
        before = self.table.copy()
        bucket, prints = self.places(hashes)
        rng = np.random.default_rng(len(hashes))
        for _ in range(ROUNDS):
            if not len(bucket):
                return
            order = np.argsort(bucket, kind="stable")
            bucket, prints = bucket[order], prints[order]
            first = np.r_[True, bucket[1:] != bucket[:-1]]
            begins = np.flatnonzero(first)
            rank = np.arange(len(bucket)) - np.repeat(begins, np.diff(np.r_[begins, len(bucket)]))
            rows = self.table[bucket]
            free = (rows == 0).sum(axis=1)
            fits = rank < free
            slot = np.argsort(rows[fits] != 0, axis=1, kind="stable")
            slot = slot[np.arange(len(slot)), rank[fits]]
            self.table[bucket[fits], slot] = prints[fits]
            bucket, prints, over = bucket[~fits], prints[~fits], (rank - free)[~fits]
            kick = over == 0
            slot = rng.integers(0, SLOTS, int(kick.sum()))
            at = bucket[kick]
            victims = self.table[at, slot].copy()
            self.table[at, slot] = prints[kick]
            prints[kick] = victims
            bucket = self.other(bucket, prints)
        if len(bucket):
            self.table = before
            raise Full

    def matches(self, hashes: np.ndarray):
        one, prints = self.places(hashes)
        two = self.other(one, prints)
        same = prints[:, None]
        return one, two, prints, self.table[one] == same, self.table[two] == same

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """How often the fingerprint of each hash is held: never less than it was inserted."""
        one, two, _, in_one, in_two = self.matches(hashes)
        return in_one.sum(axis=1) + np.where(one == two, 0, in_two.sum(axis=1))

    def remove(self, hashes: np.ndarray) -> None:
        """Take back one insertion of each hash; each must have been inserted."""
        left = hashes
        while len(left):
            one, two, prints, _, _ = self.matches(left)
            pair = np.minimum(one, two) << 16 | prints.astype(np.int64)
            _, turn = np.unique(pair, return_index=True)
            one, two, _, in_one, in_two = self.matches(left[turn])
            if not (in_one.any(axis=1) | in_two.any(axis=1)).all():
                raise ValueError("a hash that was not inserted can't be removed")
            here = in_one.any(axis=1)
            at = np.where(here, one, two)
            slot = np.where(here, in_one.argmax(axis=1), in_two.argmax(axis=1))
            self.table[at, slot] = 0
            left = np.delete(left, turn)
