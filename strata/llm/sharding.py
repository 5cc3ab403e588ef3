"""Sharding by best-fit-decreasing bin packing of indivisible groups (equal texts).

Groups by falling size enter the shard with the tightest remaining capacity that still takes
them, found in a balanced tree. With a fixed number of shards, the capacity is the smallest one
(by bisection) for which best fit needs no more shards than that, which makes sizes near equal.

Groups of one size are interchangeable, so the decision is made on the number of groups of each
size, counted by Spark: runs of equal groups go to runs of equal shards. D different sizes take
D * D / 2 bytes at least, so the driver's list grows with the root of the input at most. Each
group then finds its shard from its rank among the groups of its size, and each document its slot
from its rank in the shard. Ranks are a rank in the task plus a prefix sum over tasks, so neither
groups of a size nor documents of a shard ever meet in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, prepare

#: Groups of at least one row in so many find their shard by a broadcast, the others by a shuffle.
HOT = 1000


class Tree:
    """A treap of (remaining capacity, shard): insert, and take out the smallest entry that is
    not below a key, both in logarithmic time. Priorities are a hash of the shard."""

    def __init__(self):
        self.root = None  # [key, priority, left, right]

    def insert(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        priority = (key[1] + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        self.root = self._merge(self._merge(low, [key, priority, None, None]), high)

    def take(self, key: tuple[int, int]):
        """The smallest entry >= key, removed; None if there is none."""
        low, high = self._split(self.root, key)
        if high is None:
            self.root = low
            return None
        least = high
        while least[2] is not None:
            least = least[2]
        _, rest = self._split(high, (least[0][0], least[0][1] + 1))
        self.root = self._merge(low, rest)
        return least[0]

    def _split(self, t, key):
        """(entries < key, entries >= key)"""
        if t is None:
            return None, None
        if t[0] < key:
            t[3], high = self._split(t[3], key)
            return t, high
        low, t[2] = self._split(t[2], key)
        return low, t

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b


def plan(sizes: list[int], counts: list[int], capacity: int,
         most: int | None = None) -> np.ndarray | None:
    """Rows (size, rank, each, shard, groups): the ``groups`` groups of this size from ``rank`` on
    go, ``each`` at a time, to the shards from ``shard`` on. Sizes are given falling; a group over
    the capacity gets a shard of its own. None as soon as more than ``most`` shards are needed."""
    tree, used, out = Tree(), 0, []
    number: dict[int, int] = {}  # shards of the open run that starts with this one
    for size, left in zip(sizes, counts):
        rank = 0
        while left:
            found = tree.take((size, -1))
            if found is None:
                room, first = max(capacity, size), used
                have = -(-left // (room // size))
                used += have
                if most is not None and used > most:
                    return None
            else:
                room, first = found
                have = number.pop(first)
            each = room // size  # the same shard stays the tightest until it is full
            full = min(have, left // each)
            rest = left - full * each if full < have else 0
            for start, shards, some in ((first, full, each), (first + full, int(rest > 0), rest)):
                if shards:
                    out.append((size, rank, some, start, shards * some))
                    rank += shards * some
                    left -= shards * some
                    tree.insert((room - some * size, start))
                    number[start] = shards
            start = first + full + (rest > 0)
            if start < first + have:
                tree.insert((room, start))
                number[start] = first + have - start
    return np.array(out, np.int64).reshape(-1, 5)


def best_fit(sizes: np.ndarray, capacity: int, most: int | None = None) -> np.ndarray | None:
    """Shard of each item, items given by falling size."""
    kinds, counts = np.unique(sizes, return_counts=True)
    rows = plan(kinds[::-1].tolist(), counts[::-1].tolist(), capacity, most)
    if rows is None:
        return None
    return np.concatenate([np.zeros(0, np.int64), *(
        first + np.arange(groups) // each for _, _, each, first, groups in rows.tolist())])


def level(sizes: list[int], counts: list[int], shards: int) -> np.ndarray:
    """The plan for ``shards`` shards at the smallest capacity that bisection finds."""
    if not sizes:
        return np.zeros((0, 5), np.int64)
    low = max(sizes[0], -(-sum(s * c for s, c in zip(sizes, counts)) // shards))
    high, best = low, plan(sizes, counts, low, shards)
    while best is None:
        high += max(1, high // 64)
        best = plan(sizes, counts, high, shards)
    while high - low > max(1, low // 20_000):
        middle = (low + high) // 2
        found = plan(sizes, counts, middle, shards)
        if found is None:
            low = middle
        else:
            best, high = found, middle
    return best


def _ranks(name: str):
    """Rank of each row among its task's rows of the same value of ``name``."""
    def run(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            value = b.column(name).to_numpy()
            order = np.argsort(value, kind="stable")
            kinds, first, n = np.unique(value[order], return_index=True, return_counts=True)
            rank = np.empty(len(value), np.int64)
            rank[order] = np.arange(len(value)) - np.repeat(first, n) + np.repeat(
                [seen.get(k, 0) for k in kinds.tolist()], n)
            for k, c in zip(kinds.tolist(), n.tolist()):
                seen[k] = seen.get(k, 0) + c
            yield pa.RecordBatch.from_arrays(
                b.columns + [pa.array(np.full(len(b), part, np.int32)), pa.array(rank)],
                names=[*b.schema.names, "part", "rank"])
    return run


def _ranked(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the rank of each row among those of the same ``name`` (no order is meant), and
    how many rows each task had of each."""
    schema = df.select("*").schema.add("part", "integer").add("rank", "long")
    some = materialise(df.mapInArrow(_ranks(name), schema), f"by-{name}")
    counts = materialise(some.groupBy("part", name).agg(F.count("*").alias("n")), f"{name}-counts")
    before = Window.partitionBy(name).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", name, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return some.join(bases, ["part", name]).withColumn(
        "rank", F.col("rank") + F.col("base")).drop("part", "base"), counts


def _shard_of(rows: np.ndarray):
    """Look the shard of (bytes, rank) up in the plan."""
    import pandas as pd

    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    sizes, starts = np.unique(rows[:, 0], return_index=True)
    ends = np.append(starts[1:], len(rows))

    def look(size, rank):
        size, rank = size.to_numpy(), rank.to_numpy()
        kind = np.searchsorted(sizes, size)
        low, high = starts[kind], ends[kind]  # the last row of this size that starts by the rank
        while (open_ := high - low > 1).any():
            middle = (low + high) // 2
            up = rows[middle, 1] <= rank
            low, high = np.where(open_ & up, middle, low), np.where(open_ & ~up, middle, high)
        return pd.Series(rows[low, 3] + (rank - rows[low, 1]) // rows[low, 2])

    look.__annotations__ = {"size": pd.Series, "rank": pd.Series, "return": pd.Series}
    return F.pandas_udf(look, "int")


def shard_documents(docs: DataFrame, shards: int | None = None,
                    capacity: int | None = None) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 8), text_crc32, shard and slot of each document.

    Give the number of ``shards`` (sizes near equal) or the ``capacity`` of each (as few shards
    as best fit makes). Equal texts share a shard, null texts too (size 8, crc of no bytes); a
    group over a shard's capacity has a shard of its own. Rows that repeat a doc_id are rows of
    their own. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    text = F.col("text")
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.concat(F.lit("t"), text).cast("binary"))).alias("key"))
    rows = materialise(rows.withColumn("key", F.coalesce("key", F.lit(b"null"))), "sizes")
    groups, counts = _ranked(rows.groupBy("key").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("copies")), "bytes")
    # one row per different size of a group
    sized = sorted(((r["bytes"], r["n"]) for r in counts.groupBy("bytes").agg(
        F.sum("n").alias("n")).collect()), reverse=True)
    sizes, number = [r[0] for r in sized], [r[1] for r in sized]
    found = level(sizes, number, shards) if shards else plan(sizes, number, capacity)
    of_group = materialise(groups.select(
        "key", "copies", _shard_of(found)(F.col("bytes"), F.col("rank")).alias("shard")), "of-group")
    hot = F.col("copies") * HOT >= rows.count()  # of at most HOT groups
    known = rows.join(F.broadcast(of_group.where(hot).drop("copies")), "key", "left")
    other = known.where("shard is null").drop("shard").join(of_group.where(~hot), "key")
    cols = ("doc_id", "size", "text_crc32", "shard")
    placed = known.where("shard is not null").select(*cols).union(other.select(*cols))
    return _ranked(placed, "shard")[0].select(
        "doc_id", "size", "text_crc32", "shard", F.col("rank").alias("slot"))
