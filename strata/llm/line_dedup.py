"""Reversible line dedup: exact reference counts, with a cuckoo filter per shard in front.

A line's key is its stripped, lower-cased text as 128 bits. The exact table holds, per key, in how
many documents it stands. Keys in at least ``threshold`` documents are *frequent*; they are in
the cuckoo filter of their shard and in its sorted key file. Inserting or deleting documents adds
or subtracts their counts and moves only the keys that cross the threshold into or out of the
filters, so deleting documents brings lines back exactly as if they had never been there.

Cleaning reads the documents once: a line that the filter doesn't know stays; the few that it
knows are confirmed against the sorted key file (mapped, not loaded). Nothing of the texts is
shuffled; counting shuffles one row per key and batch of documents, so a line that stands in a
third of all documents is a few rows per task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (as_row, fields, map_file, materialise, prepare, text_of,
                               write_bytes)
from strata.llm.cuckoo import SLOTS, CuckooFilter
from strata.llm.kernels import NON_SPACE, U, flat, hash_ranges, runs
from strata.session import scratch_path

#: Frequent keys of a shard (2.5 MB of filter, 8 MB of keys) and bytes a task maps at once.
SHARD_KEYS, GROUP_BYTES = 500_000, 256 << 20

L = T.LongType()


class Lines:
    """Lines of a batch: which text, number of each text's lines, keys of those with content."""

    def __init__(self, texts: pa.Array, min_chars: int = 1):
        data, offsets = flat(texts)
        n = len(offsets) - 1
        breaks = np.flatnonzero(data == 10)
        until = np.searchsorted(breaks, offsets)
        self.counts = np.diff(until) + 1
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(n), self.counts)
        starts, ends = np.empty(len(self.doc), np.int64), np.empty(len(self.doc), np.int64)
        at = np.arange(len(breaks)) + np.repeat(np.arange(n), self.counts - 1)
        starts[self.first[:-1]], ends[self.first[1:] - 1] = offsets[:-1], offsets[1:]
        starts[at + 1], ends[at] = breaks + 1, breaks
        w0, w1 = runs(data, offsets, NON_SPACE)
        a = np.searchsorted(w0, starts)
        z = np.searchsorted(w1, ends, "right") - 1
        some = (a < len(w0)) & (z >= a)
        if min_chars > 1:
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            some[some] = chars[w1[z[some]]] - chars[w0[a[some]]] >= min_chars
        #: the lines with a key, and their keys
        self.keyed = np.flatnonzero(some)
        a, z = w0[a[some]], w1[z[some]]
        self.k1, self.k2 = hash_ranges(data, a, z, 0), hash_ranges(data, a, z, 1)


def _count(min_chars: int):
    """(key, documents of the batch that have it)."""
    def run(batches):
        for b in batches:
            x = Lines(text_of(b), min_chars)
            doc = x.doc[x.keyed]
            order = np.lexsort((doc, x.k2, x.k1))
            k1, k2, doc = x.k1[order], x.k2[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            other = new.copy()
            other[1:] |= doc[1:] != doc[:-1]
            at = np.flatnonzero(new)
            docs = np.add.reduceat(other.astype(np.int64), at) if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[at].view(np.int64)), pa.array(k2[at].view(np.int64)),
                 pa.array(docs, pa.int64())], names=["k1", "k2", "docs"])
    return run


def _find(keys: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Which keys stand in an (n, 2) array sorted by both halves."""
    at = np.searchsorted(keys[:, 0], k1)
    found, open_ = np.zeros(len(k1), bool), np.arange(len(k1))
    while len(open_):
        open_ = open_[at[open_] < len(keys)]
        open_ = open_[keys[at[open_], 0] == k1[open_]]
        same = keys[at[open_], 1] == k2[open_]
        found[open_[same]] = True
        open_ = open_[~same]
        at[open_] += 1
    return found


def _maintain(folder: str, old: dict):
    """Apply one shard's crossings to its filter and key file; both are written anew."""
    def run(key, t):
        shard = key[0].as_py()
        k = np.stack([t.column(c).to_numpy().view(U) for c in ("k1", "k2")], 1)
        comes = t.column("comes").to_numpy(zero_copy_only=False)
        have = old.get(shard)
        keys = np.array(map_file(have["keys"], U)).reshape(-1, 2) if have else np.zeros((0, 2), U)
        keys = keys[~_find(_sorted(k[~comes]), keys[:, 0], keys[:, 1])]
        keys = _sorted(np.concatenate([keys, k[comes]]))
        if have:
            f = CuckooFilter(np.array(map_file(have["filter"], np.uint16)).reshape(-1, SLOTS))
            f.delete(k[~comes, 0], k[~comes, 1])
            if not f.insert(k[comes, 0], k[comes, 1]):
                f = CuckooFilter.of(keys[:, 0], keys[:, 1])
        else:
            f = CuckooFilter.of(keys[:, 0], keys[:, 1])
        name = f"{folder}/shard-{shard}-{uuid.uuid4().hex}"
        write_bytes(f"{name}.filter", [np.ascontiguousarray(f.table)])
        write_bytes(f"{name}.keys", [np.ascontiguousarray(keys)])
        return pa.table({"shard": [shard], "filter": [f"{name}.filter"],
                         "keys": [f"{name}.keys"], "size": [f.table.nbytes + keys.nbytes]})
    return run


def _sorted(keys: np.ndarray) -> np.ndarray:
    return keys[np.lexsort((keys[:, 1], keys[:, 0]))]


def _clean(shards: int, files: dict, min_chars: int, last: bool):
    """Mark the lines whose key is frequent in these shards; the last group drops all marked."""
    def run(batches):
        maps = {}
        for b in batches:
            texts = text_of(b)
            x = Lines(texts, min_chars)
            drop = np.zeros(len(x.doc), bool)
            if "hit" in b.schema.names:
                hit = b.column("hit")
                drop[x.first[:-1][np.repeat(np.arange(len(b)), np.diff(hit.offsets.to_numpy()))]
                     + hit.flatten().to_numpy()] = True
            of = (x.k1 % U(shards)).astype(np.int64)
            for s in np.unique(of).tolist():
                if s not in files:
                    continue
                if s not in maps:
                    maps[s] = (CuckooFilter(map_file(files[s]["filter"], np.uint16)
                                            .reshape(-1, SLOTS)),
                               map_file(files[s]["keys"], U).reshape(-1, 2))
                f, keys = maps[s]
                m = np.flatnonzero(of == s)
                m = m[f.contains(x.k1[m], x.k2[m])]
                drop[x.keyed[m[_find(keys, x.k1[m], x.k2[m])]]] = True
            total = np.concatenate([[0], np.cumsum(drop)])
            dropped = total[x.first[1:]] - total[x.first[:-1]]
            if not last:
                at = np.flatnonzero(drop)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(dropped)]),
                                                       pa.int32()),
                                              pa.array(at - x.first[x.doc[at]], pa.int64())),
                     b.column("row")], names=["hit", "row"])
                continue
            kept = texts.to_pylist()
            for i in np.flatnonzero(dropped).tolist():
                lines = kept[i].split("\n")
                gone = drop[x.first[i]:x.first[i + 1]].tolist()
                kept[i] = "\n".join(y for y, out in zip(lines, gone) if not out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.counts, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(kept, pa.string()), b.column("row")],
                names=["n_lines", "n_dropped", "kept_text", "row"])
    return run


@dataclass
class LineIndex:
    """Reference counts of line keys and the filters of the frequent ones, one version.

    ``insert`` and ``delete`` return the next version; files of older versions stay as they are,
    so a job that is still reading one is not disturbed, and a retried task writes new names.
    """

    spark: SparkSession
    threshold: int = 10
    min_chars: int = 1
    shard_keys: int = SHARD_KEYS
    group_bytes: int = GROUP_BYTES
    shards: int = 0
    counts: DataFrame | None = None
    files: dict = field(default_factory=dict)

    def insert(self, docs: DataFrame) -> "LineIndex":
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> "LineIndex":
        """Take out documents that were inserted before (same texts)."""
        return self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> "LineIndex":
        prepare(self.spark)
        delta = docs.select("text").mapInArrow(_count(self.min_chars),
                                               "k1 long, k2 long, docs long")
        rows = delta.select("k1", "k2", F.lit(0).cast("long").alias("was"),
                            (F.col("docs") * sign).alias("more"))
        if self.counts is not None:
            rows = rows.unionByName(self.counts.select("k1", "k2", F.col("docs").alias("was"),
                                                       F.lit(0).cast("long").alias("more")))
        merged = materialise(rows.groupBy("k1", "k2").agg(F.sum("was").alias("was"),
                                                          F.sum("more").alias("more"))
                             .withColumn("docs", F.col("was") + F.col("more"))
                             .where("docs > 0 or was > 0"), "line-counts")
        now, before = F.col("docs") >= self.threshold, F.col("was") >= self.threshold
        frequent = merged.where(now).count()
        shards = self.shards
        fresh = shards == 0 or frequent > 2 * self.shard_keys * shards
        if fresh:  # first use, or grown too large for the number of shards
            shards = max(1, -(-frequent // self.shard_keys))
            crossed, old = merged.where(now).withColumn("comes", F.lit(True)), {}
        else:
            crossed, old = merged.where(now != before).withColumn("comes", now), self.files
        # a long's unsigned remainder, as the tasks take it from 64 bits
        shard = F.pmod(F.pmod(F.col("k1"), F.lit(shards))
                       + F.when(F.col("k1") < 0, (1 << 64) % shards).otherwise(0), F.lit(shards))
        new = {r["shard"]: r.asDict() for r in crossed.select(shard.alias("shard"), "k1", "k2", "comes")
               .groupBy("shard").applyInArrow(
                   _maintain(scratch_path(self.spark, "llm-line-filters"), old),
                   "shard long, filter string, keys string, size long").collect()}
        return LineIndex(self.spark, self.threshold, self.min_chars, self.shard_keys,
                         self.group_bytes, shards,
                         merged.where("docs > 0").select("k1", "k2", "docs"), old | new)

    def clean(self, docs: DataFrame) -> DataFrame:
        """Each row of ``docs`` (as struct ``row``) with n_lines, n_dropped and kept_text.

        A null or empty text is one empty line, which has no key and stays (null stays null).
        Lines are cut at \\n only; a text whose lines all go becomes empty. Repeated rows count
        as documents of their own and are cleaned alike. An empty table gives no rows.
        """
        prepare(self.spark)
        groups, room = [{}], self.group_bytes
        for s, f in sorted(self.files.items()):
            if f["size"] > room and groups[-1]:
                groups.append({})
                room = self.group_bytes
            groups[-1][s] = {"filter": f["filter"], "keys": f["keys"]}
            room -= f["size"]
        df = docs.select(as_row(docs))
        kind = df.schema["row"].dataType
        for i, g in enumerate(groups):
            last = i == len(groups) - 1
            out = (("n_lines", L), ("n_dropped", L), ("kept_text", T.StringType())) if last \
                else (("hit", T.ArrayType(L)),)
            df = df.mapInArrow(_clean(max(1, self.shards), g, self.min_chars, last),
                               fields(*out, ("row", kind)))
        return df


def line_dedup(docs: DataFrame, threshold: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line that stands in at least ``threshold`` documents of the table."""
    spark = prepare(docs.sparkSession)
    return LineIndex(spark, threshold, min_chars).insert(docs).clean(docs)
