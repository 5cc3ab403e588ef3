"""Benchmark decontamination by winnowing.

Documents and benchmark items are fingerprinted alike: of every 6 consecutive 5-word grams the
smallest hash is kept (all of them on a tie). Any 10 shared words hold 6 grams, so both sides
keep the same one: no shared span of 10 words is missed. A document fingerprint that a benchmark
item has too is extended to the 10-word windows around it, and a window that equals an item's
(128 bits over its words) makes its words hits. Items of fewer words are one window each and are
looked up as grams of their own length.

The benchmark is cut into groups of whole items of bounded size, written to the shared folder.
Documents are read once and pass the groups one after the other inside their task: nothing of
the documents is shuffled, a hot passage costs what its words cost, and a larger benchmark makes
more groups, not larger ones.
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (as_row, fields, list_array, open_fs, prepare, text_of,
                               write_bytes)
from strata.llm.kernels import LETTER_DIGIT, U, Words, grams
from strata.session import scratch_path

#: Words of a window, of a gram; a window holds WINDOW - GRAM + 1 grams.
WINDOW, GRAM = 10, 5
#: Benchmark words of a group: about 40 bytes each in a task's memory.
GROUP_WORDS = 1_000_000

L = T.LongType()


def winnow(words: Words, window: int, gram: int) -> np.ndarray:
    """Positions of the kept grams of every text, and the gram hash at each position."""
    g = grams(words.hash, gram)
    span = window - gram + 1
    n = len(g) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), g
    low = g[:n].copy()
    for j in range(1, span):
        np.minimum(low, g[j:j + n], out=low)
    doc = words.doc_of_word()
    whole = doc[:n] == doc[window - 1:]
    kept = np.zeros(len(g), bool)
    for j in range(span):
        kept[j:j + n] |= whole & (g[j:j + n] == low)
    return np.flatnonzero(kept), g


def gram_at(h: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits over the ``size`` word hashes from each start."""
    parts = h[starts[:, None] + np.arange(size)].ravel()
    step = size if len(starts) else 1
    return (grams(parts, size, 0)[::step], grams(parts, size, 1)[::step])


def _store(folder: str, window: int, gram: int):
    """One group of items -> its file: windows with their items, and kept fingerprints."""
    def run(key, t):
        w = Words(t.column("text"), LETTER_DIGIT)
        size = np.minimum(w.counts, window)
        at = np.flatnonzero(size > 0)
        n = np.where(size > 0, w.counts - size + 1, 0)
        item = np.repeat(np.arange(len(n)), n)
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        start = w.bounds[:-1][item] + np.arange(len(item)) - first[item]
        length = size[item]
        h1, h2 = np.zeros(len(item), U), np.zeros(len(item), U)
        for s in np.unique(length):
            m = length == s
            h1[m], h2[m] = gram_at(w.hash, start[m], int(s))
        order = np.lexsort((item, h2, h1, length))
        kept, g = winnow(w, window, gram)
        ids = t.column("id").to_pylist()
        buf = io.BytesIO()
        np.savez(buf, length=length[order], h1=h1[order], h2=h2[order], item=item[order],
                 ids=np.array(["" if i is None else i for i in ids], dtype=str),
                 known=np.array([i is not None for i in ids], bool),
                 kept=np.unique(g[kept]))
        name = f"{folder}/group-{key[0].as_py()}-{uuid.uuid4().hex}.npz"
        write_bytes(name, [buf.getvalue()])
        return pa.table({"group": [key[0].as_py()], "file": [name], "items": [len(at)]})
    return run


class _Group:
    """A group's tables in a task."""

    def __init__(self, file: str):
        fs, path = open_fs(file)
        with fs.open_input_stream(path) as f:
            z = np.load(io.BytesIO(f.read()))
        self.kept = z["kept"]
        self.ids, self.known = z["ids"], z["known"]
        self.tables = {}
        length, h1, h2, item = z["length"], z["h1"], z["h2"], z["item"]
        for s in np.unique(length):
            m = length == s
            self.tables[int(s)] = (h1[m], h2[m], item[m])

    def matches(self, size: int, h1: np.ndarray, h2: np.ndarray):
        """(index of the query, item) of all equal windows."""
        t1, t2, item = self.tables[size]
        lo, hi = np.searchsorted(t1, h1, "left"), np.searchsorted(t1, h1, "right")
        n = hi - lo
        q = np.repeat(np.arange(len(h1)), n)
        at = lo[q] + np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
        same = t2[at] == h2[q]
        return q[same], item[at[same]]

    def hits(self, w: Words, kept: np.ndarray, g: np.ndarray, window: int, gram: int):
        """(first word, words, item) of every occurrence of a window."""
        doc = None
        for size in self.tables:
            if size == window:
                at = np.minimum(np.searchsorted(self.kept, g[kept]), max(0, len(self.kept) - 1))
                found = kept[self.kept[at] == g[kept]] if len(self.kept) else kept[:0]
                start = (found[:, None] - np.arange(window - gram + 1)).ravel()
                start = np.unique(start[(start >= 0) & (start + size <= len(w.hash))])
            else:
                start = np.arange(max(0, len(w.hash) - size + 1))
            if len(start):
                doc = w.doc_of_word() if doc is None else doc
                start = start[doc[start] == doc[start + size - 1]]
            if not len(start):
                continue
            if size == window:
                h1, h2 = gram_at(w.hash, start, size)
            else:
                h1, h2 = grams(w.hash, size, 0)[start], grams(w.hash, size, 1)[start]
            q, item = self.matches(size, h1, h2)
            yield start[q], size, item


def _judge(files: list[str], window: int, gram: int):
    def run(batches):
        for b in batches:
            w = Words(text_of(b), LETTER_DIGIT)
            kept, g = winnow(w, window, gram)
            mask = np.zeros(len(w.hash) + 1, np.int64)
            items: dict[int, set] = {}
            for f in files:
                group = groups.get(f)
                if group is None:
                    if len(groups) >= 8:  # bounds the task's memory; files are read again
                        groups.clear()
                    group = groups[f] = _Group(f)
                for start, size, item in group.hits(w, kept, g, window, gram):
                    np.add.at(mask, start, 1)
                    np.add.at(mask, start + size, -1)
                    doc = np.searchsorted(w.bounds, start, "right") - 1
                    pairs = np.unique(np.stack([doc, item], 1), axis=0)
                    for d, i in pairs[group.known[pairs[:, 1]]].tolist():
                        items.setdefault(d, set()).add(str(group.ids[i]))
            hit = np.cumsum(mask[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[w.bounds[1:]] - total[w.bounds[:-1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            spans, per = [], np.zeros(len(b), np.int64)
            for a, z in edge.reshape(-1, 2).tolist():
                d = int(np.searchsorted(w.bounds, a, "right")) - 1
                while a < z:  # a run may go on into the next text
                    end = min(z, int(w.bounds[d + 1]))
                    if end > a:
                        spans += [a - int(w.bounds[d]), end - int(w.bounds[d])]
                        per[d] += 2
                    a, d = max(a, end), d + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.counts, pa.int64()), pa.array(n_hit, pa.int64()),
                 list_array(np.array(spans, np.int64), per, pa.int64()),
                 pa.array([sorted(items.get(i, ())) for i in range(len(b))],
                          pa.list_(pa.string())), b.column("row")],
                names=["n_words", "n_hit", "spans", "items", "row"])
    groups: dict[str, _Group] = {}
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  group_words: int = GROUP_WORDS, keep_columns: bool = True) -> DataFrame:
    """Each row of ``docs`` (as struct ``row``) with n_words, n_hit (words inside an occurrence
    of a benchmark window), spans (first and end word of each run of hits) and items (sorted ids,
    as strings, of the items with an occurring window).

    Null and empty texts have no words and no hits. Items without words match nothing; an item
    with a null id makes hits and is not listed; items that repeat an id count once. Repeated
    documents are judged alike. An empty benchmark leaves every document clean; an empty table
    gives no rows.
    """
    spark = prepare(docs.sparkSession)
    source = docs.select(as_row(docs, keep_columns))
    kind = source.schema["row"].dataType
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text")
    # a word takes two bytes and more: an upper bound without cutting words
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // (2 * group_words)))
    folder = scratch_path(spark, "llm-benchmark")
    files = [r["file"] for r in items
             .withColumn("group", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
             .groupBy("group").applyInArrow(_store(folder, window, gram),
                                            "group long, file string, items long")
             .orderBy("group").collect()]
    return source.mapInArrow(_judge(files, window, gram), fields(
        ("n_words", L), ("n_hit", L), ("spans", T.ArrayType(L)),
        ("items", T.ArrayType(T.StringType())), ("row", kind)))
