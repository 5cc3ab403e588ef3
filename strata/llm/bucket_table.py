"""Counts of hashed n-grams in a table of any size, kept as files of bucket ranges.

A task sorts the buckets that it meets and sends them per range as one compressed block: gaps
between buckets and their counts. The task that owns a range adds its blocks one after the other
and writes the range to the shared folder. Readers map the files and look buckets up range by
range. Neither the driver nor any task holds a whole table, a block's size is bounded by HELD, and
all blocks together by the distinct n-grams of each task's texts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import map_file, write_bytes
from strata.session import scratch_path

#: Buckets of a range (16 bytes each while it is added up); distinct ones that a task gathers, and
#: n-grams that it counts, before it sends them.
RANGE, HELD, MOST = 1 << 19, 1 << 21, 1 << 30
BLOCK = "part int, n int, block binary"


def grown(size: int, each: int, least: int, linear: int) -> int:
    """Buckets for ``size`` bytes: one for ``each`` bytes up to ``linear`` buckets, from there on by
    the square root (as a vocabulary grows with its corpus); a power of two, without a limit."""
    n = size // each
    if n > linear:
        n = int((linear * n) ** 0.5)
    return max(least, 1 << n.bit_length())


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys once each, the numbers of equal ones added."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(n, at)


class Tally:
    """What a task has counted and not sent yet."""

    def __init__(self):
        self.parts, self.held, self.seen = [], 0, 0

    def add(self, bucket: np.ndarray, marked: np.ndarray) -> None:
        if len(bucket):
            keys = np.sort((bucket << 1) | marked)
            self.parts.append(_added(keys, np.ones(len(keys), np.int64)))
            self.held += len(self.parts[-1][0])
            self.seen += len(keys)

    def full(self) -> bool:
        return self.held > HELD or self.seen > MOST

    def send(self):
        """One batch of blocks, a row per range; the tally is empty then."""
        if not self.parts:
            return
        keys, n = (np.concatenate(x) for x in zip(*self.parts))
        self.__init__()
        order = np.argsort(keys, kind="stable")  # runs are sorted: merged
        keys, n = _added(keys[order], n[order])
        at = np.flatnonzero(np.concatenate([[True], keys[1:] >> 1 != keys[:-1] >> 1]))
        total, marked = np.add.reduceat(n, at), np.add.reduceat(np.where(keys & 1, n, 0), at)
        bucket = keys[at] >> 1
        part = bucket // RANGE
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
        blocks = [_pack(bucket[a:z] % RANGE, total[a:z], marked[a:z])
                  for a, z in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[cuts[:-1]], pa.int32()), pa.array(np.diff(cuts), pa.int32()),
             pa.array(blocks, pa.binary())], names=["part", "n", "block"])


def _pack(bucket: np.ndarray, total: np.ndarray, marked: np.ndarray) -> bytes:
    """Gaps and both counts, byte by byte apart: most bytes are 0."""
    rows = np.stack([np.diff(bucket, prepend=0), total, marked]).astype(np.uint32)
    planes = rows.view(np.uint8).reshape(3, -1, 4).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(block: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = pa.decompress(block, 12 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(3, 4, n).transpose(0, 2, 1)
    gaps, total, marked = np.ascontiguousarray(planes).view(np.uint32)[:, :, 0].astype(np.int64)
    return np.cumsum(gaps), total, marked


def _write(folder: str, size: int, added: float):
    """Add up the blocks of each range, which follow one another, and write it: (log of marked by
    total) as float32 for scoring, and the counts."""
    def finish(part, counts):
        name = f"{folder}/part-{part}-{uuid.uuid4().hex}"
        p = np.log(counts + added)
        write_bytes(f"{name}.ratio", [(p[1] - p[0]).astype(np.float32)])
        write_bytes(f"{name}.counts", [counts])
        return pa.RecordBatch.from_pylist([{"part": part, "name": name, "total": int(counts[0].sum()),
                                            "marked": int(counts[1].sum())}])

    def run(batches):
        part = counts = None
        for b in batches:
            for p, n, block in zip(*(b.column(c).to_pylist() for c in ("part", "n", "block"))):
                if p != part:
                    if part is not None:
                        yield finish(part, counts)
                    part, counts = p, np.zeros((2, size), np.int64)
                at, total, marked = _unpack(block, n)
                counts[0, at] += total
                counts[1, at] += marked
        if part is not None:
            yield finish(part, counts)
    return run


@dataclass
class BucketTable:
    """A written table: its number of buckets, both sums, and the files of each range that has any."""

    buckets: int
    files: dict[int, str] = field(default_factory=dict)
    total: int = 0
    marked: int = 0

    @property
    def size(self) -> int:
        return min(self.buckets, RANGE)

    def reader(self) -> "Reader":
        return Reader(self)


class Reader:
    """Looks buckets up in the mapped files of a table; made in the task that reads."""

    def __init__(self, table: BucketTable):
        self.table, self.maps = table, {}

    def __len__(self) -> int:
        return self.table.buckets

    def _map(self, part: int, kind: str, dtype) -> np.ndarray:
        if (part, kind) not in self.maps:
            self.maps[part, kind] = map_file(f"{self.table.files[part]}.{kind}", dtype)
        return self.maps[part, kind]

    def _parts(self, at: np.ndarray):
        """(range, which of ``at`` lie in it); ranges without any count stay out."""
        return ((p, which) for p, which in self._split(at) if p in self.table.files)

    def _split(self, at: np.ndarray):
        n = -(-self.table.buckets // self.table.size)
        if n == 1:
            yield 0, slice(None)
            return
        part = (at // self.table.size).astype(np.uint16 if n <= 1 << 16 else np.uint32)
        order = np.argsort(part, kind="stable")  # 16 bits: a radix sort
        part = part[order]
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        for a, z in zip(cuts[:-1], cuts[1:]):
            if z > a:
                yield int(part[a]), order[a:z]

    def ratios(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.float32)
        for part, which in self._parts(at):
            out[which] = self._map(part, "ratio", np.float32)[at[which] % self.table.size]
        return out

    def counts(self, at: np.ndarray) -> np.ndarray:
        """(total and marked, one column per bucket asked for)"""
        out = np.zeros((2, len(at)), np.int64)
        for part, which in self._parts(at):
            have = self._map(part, "counts", np.int64)
            out[:, which] = have.reshape(2, -1)[:, at[which] % self.table.size]
        return out


def write_table(blocks: DataFrame, buckets: int, added: float) -> BucketTable:
    """The table of the blocks (rows of BLOCK) that tallies sent. The driver gets a row per range."""
    spark, table = blocks.sparkSession, BucketTable(buckets)
    parts = -(-buckets // table.size)
    rows = (blocks.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(_write(scratch_path(spark, "llm-bucket-table"), table.size, added),
                        "part long, name string, total long, marked long").collect())
    return BucketTable(buckets, {r["part"]: r["name"] for r in rows},
                       sum(r["total"] for r in rows), sum(r["marked"] for r in rows))
