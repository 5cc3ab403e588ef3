"""Token ids as flat binary files with 64-bit document offsets, to be memory-mapped.

A shard is three files in the shared folder: ``ids`` (little-endian unsigned integers, 16 bits
where the vocabulary allows, else 32), ``offsets`` (int64, one more than there are documents,
counted from the first id of the whole corpus) and ``docs`` (the doc_ids, Arrow). Documents are
range-partitioned by id, so shards in order are the corpus in ascending order; where a shard
begins is a prefix sum over the shards' totals, one row each.

Tasks write under names of their own and hand them on in their rows: a retried or speculative
task leaves files that no manifest names, never a half-written shard.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_file, materialise, prepare, write_bytes
from strata.llm.tokens import encoder_of
from strata.session import scratch_path

READ_IDS = 1 << 20  # ids converted at once when files are read back


def _write(path: str, end_id: int, folder: str):
    """One task's sorted documents -> an ids, a counts and a docs file; one row names them."""
    def run(batches):
        encoder = encoder_of(path)
        size = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        name = f"{folder}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        counts, ids_of, total, first = [], [], 0, None

        def chunks():
            nonlocal total, first
            for b in batches:
                if first is None and len(b):
                    first = (b.column("doc_id")[0], b.column("order")[0])
                ids_of.append(b.column("doc_id"))
                ids = [x + end for x in encoder.encode(b.column("text"))]
                counts.append(np.array([len(x) // 4 for x in ids], np.int64))
                total += int(counts[-1].sum())
                yield np.frombuffer(b"".join(ids), "<u4").astype(kind)

        write_bytes(f"{name}.ids", chunks())
        if first is None:
            return
        write_bytes(f"{name}.counts", counts)
        docs = pa.table({"doc_id": pa.chunked_array(ids_of)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, docs.schema) as out:
            out.write_table(docs)
        write_bytes(f"{name}.docs", [sink.getvalue()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([first[0].as_py()], first[0].type), pa.array([first[1].as_py()], pa.int64()),
             pa.array([name]), pa.array([kind]), pa.array([docs.num_rows], pa.int64()),
             pa.array([total], pa.int64())],
            names=["first_doc", "first_order", "name", "kind", "docs", "ids"])
    return run


def _offsets(batches):
    """Add each shard's base to its running counts and write the offsets file."""
    for b in batches:
        files = []
        for name, base in zip(b.column("name").to_pylist(), b.column("base").to_pylist()):
            counts = map_file(f"{name}.counts", "<i8")
            out = np.empty(len(counts) + 1, "<i8")
            out[0] = base
            np.cumsum(counts, out=out[1:])
            out[1:] += base
            files.append(f"{name}-{uuid.uuid4().hex}.offsets")
            write_bytes(files[-1], [out])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(files, pa.string())],
                                         names=[*b.schema.names, "offsets"])


def _read(batches):
    """Documents of the named shards, from their mapped files alone."""
    for b in batches:
        for r in b.to_pylist():
            ids = map_file(f"{r['name']}.ids", r["kind"])
            offsets = map_file(r["offsets"], "<i8")
            docs = pa.ipc.open_file(pa.py_buffer(map_file(f"{r['name']}.docs", np.uint8)))
            doc_id = docs.read_all().column("doc_id")
            at = np.asarray(offsets) - r["base"]
            i = 0
            while i < len(at) - 1:
                j = max(i + 1, int(np.searchsorted(at, at[i] + READ_IDS, "right")) - 1)
                some = ids[at[i]:at[j]].astype("<u4")
                cut = (at[i:j + 1] - at[i]).tolist()
                crc = [zlib.crc32(some[x:y]) for x, y in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(i, j - i).combine_chunks(), pa.array(offsets[i:j], pa.int64()),
                     pa.array(np.diff(at[i:j + 1]), pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
                i = j


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None):
    """Write every document's ids and ``end_id`` in ascending doc_id order (nulls first, equal
    ids by a hash of their text); returns the manifest, a row per shard: name, kind, docs, ids,
    base, offsets. Null and empty texts are ``end_id`` alone. An empty table makes an empty manifest."""
    spark = prepare(docs.sparkSession)
    folder = folder or scratch_path(spark, "llm-tokens")
    order = F.xxhash64("text").alias("order")
    out = docs.select(F.col("doc_id").alias("first_doc"), F.lit(0).cast("long").alias("first_order")).schema
    for name, t in (("name", "string"), ("kind", "string"), ("docs", "long"), ("ids", "long")):
        out = out.add(name, t)
    # ids first sorted, then encoded: sampling for the ranges reads documents, no tokenizer
    shards = materialise(
        docs.select("doc_id", "text", order).repartitionByRange("doc_id", "order")
        .sortWithinPartitions("doc_id", "order").mapInArrow(_write(tokenizer, end_id, folder), out),
        "shards")
    before = (Window.orderBy(F.col("first_doc").asc_nulls_first(), "first_order", "name")
              .rowsBetween(Window.unboundedPreceding, -1))
    based = shards.select("name", "kind", "docs", "ids",
                          F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    schema = based.select("*", F.lit("").alias("offsets")).schema
    return materialise(_spread(based).mapInArrow(_offsets, schema), "manifest")


def _spread(shards: DataFrame) -> DataFrame:
    """About one shard a task: by their small rows alone, shards would be coalesced into one."""
    return shards.repartition(max(1, shards.count()), "name")


def read_tokens(manifest: DataFrame, doc_id_type) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over 32-bit ids) of every document in the files."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("doc_id", doc_id_type)]
                          + [T.StructField(c, T.LongType())
                             for c in ("start", "n_tokens", "ids_crc32")])
    return _spread(manifest).mapInArrow(_read, schema)
