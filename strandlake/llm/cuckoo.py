"""Cuckoo filters over 64-bit hashes, built, probed and cleared in numpy batches.

Four 16-bit fingerprints to a bucket; a fingerprint's two buckets are each other's
partner (partial-key cuckoo hashing), so entries can be deleted again.
"""

from __future__ import annotations

import struct

import numpy as np

from strandlake.llm.runtime import mix64

SLOTS = 4
ROUNDS = 400


class CuckooFilter:
    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)

    @classmethod
    def for_items(cls, n: int) -> "CuckooFilter":
        buckets = 4
        while buckets * SLOTS * 0.85 < n:
            buckets *= 2
        return cls(buckets)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(hashes, 1)
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        return mark, (h & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _partner(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark, 2) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def add(self, hashes: np.ndarray) -> bool:
        """Adds distinct new items; False: no room, the filter has to be built larger."""
        mark, bucket = self._places(hashes)
        rng = np.random.default_rng(len(self.table))
        for round_ in range(ROUNDS):
            if not len(mark):
                return True
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            begin = np.flatnonzero(new)
            rank = np.arange(len(bucket)) - np.repeat(begin, np.diff(np.append(begin, len(bucket))))
            empty = self.table[bucket] == 0
            fits = rank < empty.sum(1)
            slot = (np.cumsum(empty[fits], 1) == (rank[fits] + 1)[:, None]).argmax(1)
            self.table[bucket[fits], slot] = mark[fits]
            mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
            if round_ == 0:  # the other bucket first, before anything is moved
                bucket = self._partner(bucket, mark)
                continue
            # one item a bucket takes a slot; what lay there goes on to its partner
            first = np.concatenate([[True], bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, bool)
            at, slot = bucket[first], rng.integers(0, SLOTS, int(first.sum()))
            out = self.table[at, slot].copy()
            self.table[at, slot] = mark[first]
            mark = np.concatenate([out, mark[~first]])
            bucket = np.concatenate([self._partner(at, out), bucket[~first]])
        return not len(mark)

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """True where an item may be present; False is certain."""
        mark, bucket = self._places(hashes)
        hit = (self.table[bucket] == mark[:, None]).any(1)
        miss = np.flatnonzero(~hit)
        if len(miss):
            other = self._partner(bucket[miss], mark[miss])
            hit[miss] = (self.table[other] == mark[miss, None]).any(1)
        return hit

    def remove(self, hashes: np.ndarray) -> None:
        """Removes items that were added; one copy each."""
        mark, bucket = self._places(hashes)
        for second in (False, True):
            at = self._partner(bucket, mark) if second else bucket
            order = np.lexsort((mark, at))
            mark, bucket, at = mark[order], bucket[order], at[order]
            new = np.concatenate([[True], (at[1:] != at[:-1]) | (mark[1:] != mark[:-1])])[: len(at)]
            n = np.arange(len(at))
            rank = n - np.maximum.accumulate(np.where(new, n, 0)) if len(at) else n
            hit = self.table[at] == mark[:, None]
            here = rank < hit.sum(1)
            slot = (np.cumsum(hit[here], 1) == (rank[here] + 1)[:, None]).argmax(1)
            self.table[at[here], slot] = 0
            mark, bucket = mark[~here], bucket[~here]

    def dumps(self) -> bytes:
        return struct.pack("<I", len(self.table)) + self.table.tobytes()

    @classmethod
    def loads(cls, data: bytes) -> "CuckooFilter":
        out = cls(1)
        out.table = np.frombuffer(data, np.uint16, offset=4).reshape(struct.unpack_from("<I", data)[0], SLOTS).copy()
        return out


def build(hashes: np.ndarray) -> CuckooFilter:
    """A filter that holds all the hashes, as large as it takes."""
    found = CuckooFilter.for_items(len(hashes))
    while not found.add(hashes):
        found = CuckooFilter(2 * len(found.table))
    return found
