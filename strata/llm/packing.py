"""Vector best-fit packing of documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (sum of squared lengths).
A piece of length n asks for (n, 1, n * n). Best fit decreasing: pieces by falling length go to
the feasible sequence whose weighted residual vector is shortest after taking them.

Pieces of one length are interchangeable, and so are sequences with the same residual vector. So
the decision is made once for all, on the number of pieces of each length (at most ``tokens``
numbers, however large the corpus): runs of equal pieces go to runs of equal sequences. Each piece
then finds its place from its rank among the pieces of its length, which is its rank in its task
plus a prefix sum over tasks. No group of pieces meets in one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_row, materialise, prepare, text_of, tidy
from strata.llm.tokens import encoder_of

#: Capacities of a sequence. A sequence of n tokens has at most n documents and a cost of n * n,
#: so by default only the tokens bind and sequences are as few as best fit makes them.
TOKENS = 4096
#: Weights of the residual norm: tokens first, then documents and cost to break ties.
WEIGHTS = (1.0, 1e-6, 1e-6)


def plan(counts: dict[int, int], tokens: int = TOKENS, docs: int | None = None,
         cost: int | None = None, weights=WEIGHTS) -> np.ndarray:
    """Rows (length, rank, pieces, sequence, offset): the pieces of this length from ``rank`` on
    go, one each, to the sequences from ``sequence`` on, at ``offset``."""
    full = np.array([tokens, docs or tokens, cost or tokens * tokens], np.int64)
    room = np.zeros((0, 3), np.int64)      # residual vectors of the open sequences
    runs: list[list[tuple[int, int]]] = []  # their sequences as (first, number)
    where: dict[tuple, int] = {}
    out, opened, w = [], 0, np.array(weights)

    def put(vector, some):
        """Sequences with this residual vector; full ones are done."""
        nonlocal room
        if vector[0] <= 0 or vector[1] <= 0 or vector[2] <= 0:
            return
        key = tuple(int(x) for x in vector)
        if key in where:
            runs[where[key]].extend(some)
        else:
            where[key] = len(runs)
            runs.append(list(some))
            room = np.vstack([room, np.array([key])])

    for n in sorted(counts, reverse=True):
        left, rank = counts[n], 0
        need = np.array([n, 1, n * n], np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {n} tokens fits no sequence")
        while left:
            fits = np.flatnonzero((room >= need).all(axis=1)) if len(room) else []
            if len(fits):
                rest = (room[fits] - need) / full
                state = int(fits[np.argmin((w * rest * rest).sum(axis=1))])
                vector, some = room[state].copy(), runs[state]
            else:
                state, vector = -1, full.copy()
                some = None
            each = int(min((vector // need).min(), left))  # the same sequence stays the tightest
            take = left // each
            if some is None:
                some = [(opened, take)]
                opened += take
            taken, rest_runs = [], []
            for first, number in some:
                use = min(number, take)
                if use:
                    taken.append((first, use))
                    take -= use
                if number > use:
                    rest_runs.append((first + use, number - use))
            for j in range(each):
                for first, number in taken:
                    out.append((n, rank, number, first, int(full[0] - vector[0]) + j * n))
                    rank += number
                    left -= number
            if state >= 0:
                if rest_runs:
                    runs[state] = rest_runs
                else:  # the last state moves into the hole
                    del where[tuple(int(x) for x in vector)]
                    end = len(runs) - 1
                    if state != end:
                        where[tuple(int(x) for x in room[end])] = state
                        room[state], runs[state] = room[end], runs[end]
                    room, runs = room[:-1].copy(), runs[:-1]
            put(vector - each * need, taken)
    return np.array(out, np.int64).reshape(-1, 5)


def _cut(path: str, tokens: int, end_id: int):
    """Documents -> pieces with their ids and their rank among the task's pieces of a length."""
    def run(batches):
        encoder, seen, part = encoder_of(path), {}, TaskContext.get().partitionId()
        row = cols = None
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            row, cols = [], {k: [] for k in ("piece", "start", "length", "rank", "ids", "crc")}
            for i, ids in enumerate(encoder.encode(text_of(b))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * tokens)):
                    some = ids[at:at + 4 * tokens]
                    n = len(some) // 4
                    rank = seen.get(n, 0)
                    seen[n] = rank + 1
                    row.append(i)
                    for k, v in zip(cols, (piece, at // 4, n, rank, some, zlib.crc32(some))):
                        cols[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("row").field("doc_id").take(pa.array(row, pa.int64())),
                 pa.array([part] * len(row), pa.int32()), pa.array(cols["piece"], pa.int32()),
                 pa.array(cols["start"], pa.int64()), pa.array(cols["length"], pa.int64()),
                 pa.array(cols["rank"], pa.int64()), pa.array(cols["ids"], pa.binary()),
                 pa.array(cols["crc"], pa.int64())],
                names=["doc_id", "part", "piece", "start", "length", "rank", "ids", "ids_crc32"])
        del encoder, row, cols
        tidy()
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, tokens: int = TOKENS,
         max_docs: int | None = None, max_cost: int | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (unsigned 32-bit little-endian),
    ids_crc32, sequence_id, offset.

    A document's ids are those of its whole text and ``end_id``; null and empty texts are
    ``end_id`` alone. Only documents over ``tokens`` are cut. Null and repeated doc_ids are
    packed like others, as documents of their own. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(as_row(docs, keep=False))
    kind = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", kind),
                        T.StructField("part", T.IntegerType()),
                        T.StructField("piece", T.IntegerType()),
                        *[T.StructField(c, T.LongType()) for c in ("start", "length", "rank")],
                        T.StructField("ids", T.BinaryType()),
                        T.StructField("ids_crc32", T.LongType())])
    pieces = materialise(rows.mapInArrow(_cut(tokenizer, tokens, end_id), out), "pieces", "zstd")
    per_task = materialise(pieces.groupBy("part", "length").agg(F.count("*").alias("c")), "counts")
    counts = {r["length"]: r["c"] for r in
              per_task.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    places = plan(counts, tokens, max_docs, max_cost)
    order = np.lexsort((places[:, 1], places[:, 0]))
    places = places[order]
    before = (Window.partitionBy("length").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = per_task.select("part", "length", F.coalesce(F.sum("c").over(before), F.lit(0))
                            .alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn(
        "rank", F.col("rank") + F.col("base")).drop("part", "base")
    return ranked.withColumn("place", _place(places)(F.col("length"), F.col("rank"))).select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32",
        F.col("place.sequence_id").alias("sequence_id"), F.col("place.offset").alias("offset"))


def _place(places: np.ndarray):
    """Look the place of (length, rank) up in the sorted plan."""
    import pandas as pd

    key = places[:, 0] << 44 | places[:, 1]

    def look(length, rank):
        at = np.searchsorted(key, length.to_numpy() << 44 | rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": places[at, 3] + rank.to_numpy() - places[at, 1],
                             "offset": places[at, 4]})

    look.__annotations__ = {"length": pd.Series, "rank": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(look, "sequence_id long, offset long")
