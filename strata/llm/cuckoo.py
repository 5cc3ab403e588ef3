"""A cuckoo filter over 128-bit keys: approximate membership with deletion, in one array."""

from __future__ import annotations

import numpy as np

from strata.llm.kernels import mix

SLOTS, KICKS = 4, 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints. A key lies in one of two buckets; either is found
    from the other and the fingerprint alone, so entries can be moved and deleted. Every
    inserted key is found; others are with a chance of about 8 in 65536."""

    def __init__(self, table: np.ndarray):
        self.table = table  # (buckets, SLOTS) of uint16, buckets a power of two, 0 is free

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        buckets = 1
        while buckets * SLOTS * 0.85 < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> "CuckooFilter":
        """A filter of these keys; when they don't fit, one of twice the size."""
        f = cls.sized(max(1, len(k1)))
        while not f.insert(k1, k2):
            f = cls.sized(int(f.table.size))
        return f

    def _places(self, k1: np.ndarray, k2: np.ndarray):
        mask = np.uint64(len(self.table) - 1)
        fp = (k2 >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        one = (k1 >> np.uint64(20)) & mask
        return fp, one.astype(np.int64), (one ^ (self._jump(fp) & mask)).astype(np.int64)

    @staticmethod
    def _jump(fp: np.ndarray) -> np.ndarray:
        return mix(fp.astype(np.uint64))

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        fp, one, two = self._places(k1, k2)
        hit = (self.table[one] == fp[:, None]).any(axis=1)
        return hit | (self.table[two] == fp[:, None]).any(axis=1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False when a key found no place (the filter is then to be rebuilt larger)."""
        rows = self.table.tolist()
        mask = len(rows) - 1
        fps, ones, twos = (x.tolist() for x in self._places(k1, k2))
        jump = self._jump(np.arange(65536, dtype=np.uint16)).astype(np.uint64).tolist()
        turn = 0
        for fp, one, two in zip(fps, ones, twos):
            at = one if 0 in rows[one] else two
            for _ in range(KICKS):
                row = rows[at]
                if 0 in row:
                    row[row.index(0)] = fp
                    break
                turn = (turn + 1) % SLOTS
                row[turn], fp = fp, row[turn]
                at ^= jump[fp] & mask
            else:
                return False
        self.table = np.array(rows, np.uint16).reshape(-1, SLOTS)
        return True

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Take out keys that were inserted before, one entry each."""
        for fp, one, two in zip(*(x.tolist() for x in self._places(k1, k2))):
            for at in (one, two):
                slot = np.flatnonzero(self.table[at] == fp)
                if len(slot):
                    self.table[at, slot[0]] = 0
                    break
