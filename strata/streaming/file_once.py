"""Ingest every landed file exactly once, then stop (``availableNow``).

The file-stream source's checkpoint remembers which files were committed, so a
rerun reads only files that landed since; a failed run re-reads just the
uncommitted ones. That is the streaming form of "upload only files not seen
before, remember only successes" — no driver-side file listing or state file.

Sinks are idempotent per micro-batch id, because ``foreachBatch`` is
at-least-once: a replayed batch overwrites its own output instead of adding a
second copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.jsonl import JSON_OPTIONS


def read_new_files(spark: SparkSession, path: str, schema: T.StructType | None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines by ``schema``, or the lines themselves (``value``) where it is ``None``."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if schema is None:
        return reader.text(path)
    return reader.schema(schema).options(**JSON_OPTIONS).json(path)


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:  # surface a failed micro-batch
        raise RuntimeError(str(q.exception()))


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def next_batch_id(spark: SparkSession, sink: str) -> int:
    """The id after the newest batch folder of an ingest sink; 0 for a new sink. It reads the sink:
    give ``ingest_new_files`` a registry's ``next_id`` where history grows."""
    df = _read_if_there(spark, sink)
    top = df.agg(F.max("_batch_id")).first()[0] if df is not None else None
    return 0 if top is None else int(top) + 1


def _first_id(spark: SparkSession, checkpoint: str, next_id: Callable[[], int]) -> int:
    """What is added to this checkpoint's micro-batch ids, which start at 0 in every fresh one.

    Fixed once, before the first run, and kept inside the checkpoint: a full reload (a fresh
    checkpoint over an old sink) continues the ids instead of repeating them, and a replayed
    micro-batch gets the id that it had.
    """
    path = f"{checkpoint.rstrip('/')}/first_id"
    kept = _read_if_there(spark, path)
    if kept is None:
        spark.range(1).select(F.lit(next_id()).cast("long").alias("first_id")) \
            .write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
    return kept.first()[0]


def ingest_new_files(spark: SparkSession, path: str, schema: T.StructType | None, sink: str,
                     checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     max_files_per_trigger: int | None = None,
                     next_id: Callable[[], int] | None = None,
                     on_batch: Callable[[int, str], None] | None = None) -> None:
    """Append every not-yet-seen file under ``path`` to ``sink`` (one folder per batch).

    Each micro-batch lands in ``sink/_batch_id=<id>`` with overwrite, so a replay
    after a failure replaces its own folder. ``transform`` (e.g. parsing lines, timestamp
    normalisation) runs inside the micro-batch. ``max_files_per_trigger`` splits a
    large backlog (an initial load) into bounded micro-batches, each committed on
    its own. ``next_id`` gives a fresh checkpoint the id to go on with (default: from the
    sink's folders); ``on_batch(id, folder)`` registers a batch once its folder is
    written, before the checkpoint commits it, and so has to bear a repeat.
    """
    stream = read_new_files(spark, path, schema, max_files_per_trigger)
    first = _first_id(spark, checkpoint, next_id or (lambda: next_batch_id(spark, sink)))

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        folder = f"{sink.rstrip('/')}/_batch_id={first + batch_id}"
        out.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        if on_batch:
            on_batch(first + batch_id, folder)

    _run(stream.writeStream
         .option("checkpointLocation", checkpoint).foreachBatch(write))


def stream_upsert(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str,
                  apply_batch: Callable[[DataFrame, int], None],
                  max_files_per_trigger: int | None = None) -> None:
    """Run ``apply_batch(micro_batch, batch_id)`` for the files that landed since the
    last run; ``apply_batch`` must be idempotent per batch id (see
    ``strata.plans.pipeline.SnapshotUpsert``). ``max_files_per_trigger`` bounds a micro-batch.
    With a fresh checkpoint the ids go on from ``apply_batch.next_id()``, if it has that."""
    stream = read_new_files(spark, path, schema, max_files_per_trigger)
    first = _first_id(spark, checkpoint, getattr(apply_batch, "next_id", lambda: 0))
    _run(stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, batch_id: apply_batch(batch, first + batch_id)))
