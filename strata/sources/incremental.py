"""Incremental extract with a high-water mark, kept as a small state table.

* ``extract_since`` — rows whose version is strictly newer than the mark,
  ordered by version, stamped with lineage (one extraction time per batch).
* ``load_watermarks`` — registry of tables left-joined with the saved state; a
  table without state starts at the epoch.
* ``advance_watermarks`` — new mark = max version *of the extracted batch*
  (rows committed after the extract are picked up next time); an empty batch
  keeps the old mark.

* ``extract_run`` — a whole run: batches written, marks read back from what was written, and both
  committed by one new state entry.

The state is a table with one row per source table (``table_name``, ``high_water_mark``), stored
next to the landing folder, not a driver-side dict. It is kept as numbered entries
``<state>/run=<n>``, each written once; the newest complete one counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import EPOCH, LINEAGE_EXTRACTED_AT, LINEAGE_SOURCE_TABLE
from strata.sources import jsonl

STATE_SCHEMA = T.StructType([T.StructField("table_name", T.StringType(), False),
                             T.StructField("high_water_mark", T.TimestampNTZType(), True)])


def _ts(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def stamp_lineage(df: DataFrame, table: str, extracted_at: str | Column) -> DataFrame:
    """Add ``_extracted_at`` (one value for the whole batch) and ``_source_table``."""
    ts = extracted_at if isinstance(extracted_at, Column) else F.lit(extracted_at)
    return df.withColumns({LINEAGE_EXTRACTED_AT: ts, LINEAGE_SOURCE_TABLE: F.lit(table)})


def extract_since(source: DataFrame, since: str | Column | None, version: str = "updated_at",
                  table: str | None = None, extracted_at: str | Column | None = None,
                  ordered: bool = True, overlap_seconds: int = 0) -> DataFrame:
    """Rows with ``version > since`` (strict); ``since=None`` is a full reload.

    ``overlap_seconds`` re-reads that much before the mark, so rows committed in
    the same second as the mark (versions have one-second resolution at the
    source) are not lost; re-reading is harmless because the newer-wins merge
    ignores versions it already has. The predicate is a plain comparison, so on a
    Parquet/JDBC source it is pushed into the scan. Ordering is only needed when
    the batch is written in order.
    """
    if since is None:
        df = source
    else:
        mark = _ts(since)
        if overlap_seconds:
            mark = mark - F.expr(f"INTERVAL {int(overlap_seconds)} SECONDS")
        df = source.filter(F.col(version) > mark)
    if table is not None:
        df = stamp_lineage(df, table, extracted_at if extracted_at is not None
                           else F.current_timestamp())
    return df.orderBy(version) if ordered else df


def registry(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in tables], "table_name string")


def load_watermarks(spark: SparkSession, tables: Sequence[str],
                    state: DataFrame | None = None) -> DataFrame:
    """One row per registered table; missing state -> epoch (never a KeyError)."""
    reg = registry(spark, tables)
    if state is None:
        state = spark.createDataFrame([], STATE_SCHEMA)
    return (reg.join(state.select("table_name", "high_water_mark"), "table_name", "left")
               .select("table_name",
                       F.coalesce(F.col("high_water_mark").cast("timestamp_ntz"), _ts(EPOCH))
                       .alias("high_water_mark")))


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The saved state table, or ``None`` when none was written yet."""
    try:
        return spark.read.schema(STATE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def batch_marks(batches: dict[str, DataFrame], version: str = "updated_at") -> DataFrame:
    """(table_name, batch_max): max version of each extracted batch (NULL if empty)."""
    return reduce(DataFrame.unionByName, [
        b.agg(F.max(F.col(version).cast("timestamp_ntz")).alias("batch_max"))
         .select(F.lit(name).alias("table_name"), "batch_max")
        for name, b in batches.items()])


def advance_watermarks(state: DataFrame, batches: dict[str, DataFrame],
                       version: str = "updated_at") -> DataFrame:
    """Next state: the batch maximum where a batch had rows, the old mark otherwise."""
    marks = batch_marks(batches, version)
    return (state.join(marks, "table_name", "left")
                 .select("table_name",
                         F.coalesce("batch_max", "high_water_mark").alias("high_water_mark")))


def extract_all(sources: dict[str, DataFrame], state: DataFrame, version: str = "updated_at",
                extracted_at: str | Column | None = None, full: bool = False,
                overlap_seconds: int = 0) -> dict[str, DataFrame]:
    """Extract every registered table since its own mark (``full``: everything; see
    ``extract_since`` for ``overlap_seconds``).

    The state holds one row per registered table (metadata, bounded by the
    registry), so the marks are read once and applied as literal predicates:
    that is what lets the scan of each source skip every file and row group
    whose max version is not newer than its mark.
    """
    marks = {r["table_name"]: r["high_water_mark"]
             for r in state.select("table_name", "high_water_mark").collect()}
    stamp = extracted_at if extracted_at is not None else F.current_timestamp()
    out = {}
    for name, src in sources.items():
        since = marks.get(name)
        mark = F.lit(since).cast("timestamp_ntz") if since is not None else _ts(EPOCH)
        if overlap_seconds:
            mark = mark - F.expr(f"INTERVAL {int(overlap_seconds)} SECONDS")
        batch = src if full else src.filter(F.col(version).cast("timestamp_ntz") > mark)
        out[name] = stamp_lineage(batch, name, stamp)
    return out


# --- one run: batches and marks together -------------------------------------------------------

def _entries(spark: SparkSession, state_root: str) -> DataFrame | None:
    whole = T.StructType([*STATE_SCHEMA.fields, T.StructField("run", T.IntegerType()),
                          T.StructField("attempt", T.StringType())])
    try:
        return spark.read.schema(whole).parquet(state_root).filter("run IS NOT NULL")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def latest_state(spark: SparkSession, state_root: str) -> tuple[int, str, DataFrame | None]:
    """Number, attempt and marks of the newest complete entry; (0, "", None) before the first.

    An entry is one file, so it is there whole or not at all; what a lost driver left behind has
    no rows. Of two attempts at one number the first by name counts.
    """
    entries = _entries(spark, state_root)
    top = entries.agg(F.min(F.struct((-F.col("run")).alias("n"), "attempt")).alias("e")).first()["e"] \
        if entries is not None else None
    if top is None:
        return 0, "", None
    path = f"{state_root.rstrip('/')}/run={-top['n']}/attempt={top['attempt']}"
    return -top["n"], top["attempt"], spark.read.schema(STATE_SCHEMA).parquet(path)


def written_marks(spark: SparkSession, landing: str, batches: dict[str, tuple[str, T.StructType]],
                  version: str = "updated_at") -> DataFrame:
    """(table_name, batch_max) of batches as they stand in the landing folder: what was committed
    at the source after a batch was read is not in it, whatever the source says now."""
    read = {t: jsonl.read_source(spark, jsonl.batch_path(landing, t, batch_id),
                                 T.StructType([schema[version]]))
            for t, (batch_id, schema) in batches.items()}
    return batch_marks(read, version)


def write_run(sources: dict[str, DataFrame], landing: str, state_root: str,
              version: str = "updated_at", extracted_at: str | Column | None = None,
              full: bool = False, overlap_seconds: int = 0) -> dict[str, tuple[str, T.StructType]]:
    """First half of a run: extract and write the batches of the next run number. A run that was
    lost before its marks were committed has left batches of the same number, which are replaced."""
    spark = next(iter(sources.values())).sparkSession
    last, _, saved = latest_state(spark, state_root)
    state = load_watermarks(spark, list(sources), saved)
    batch_id, out = f"run{last + 1:06d}", {}
    for name, batch in extract_all(sources, state, version, extracted_at, full,
                                   overlap_seconds).items():
        batch.write.mode("overwrite").options(**jsonl.JSON_OPTIONS) \
            .json(jsonl.batch_path(landing, name, batch_id))
        out[name] = (batch_id, batch.schema)
    return out


def commit_run(spark: SparkSession, batches: dict[str, tuple[str, T.StructType]], landing: str,
               state_root: str, version: str = "updated_at") -> DataFrame:
    """Second half: the marks of the written batches become the state's next entry, which commits
    the batches. Entries are never overwritten: of two runs that took the same number, the one whose
    entry doesn't count fails here."""
    last, _, saved = latest_state(spark, state_root)
    state = load_watermarks(spark, list(batches), saved)
    marks = written_marks(spark, landing, batches, version)
    # an empty batch keeps its mark, and a mark never goes back (overlap, full reload)
    moved = state.join(marks, "table_name", "left").select(
        "table_name", F.greatest("high_water_mark", "batch_max").alias("high_water_mark"))
    others = saved.join(moved, "table_name", "left_anti") if saved is not None else moved.limit(0)
    mine = uuid.uuid4().hex
    moved.unionByName(others).coalesce(1).write.mode("errorifexists").parquet(
        f"{state_root.rstrip('/')}/run={last + 1}/attempt={mine}")
    number, attempt, now = latest_state(spark, state_root)
    if (number, attempt) != (last + 1, mine):
        raise RuntimeError(f"another extract run has committed run {last + 1}")
    return now


def extract_run(sources: dict[str, DataFrame], landing: str, state_root: str,
                version: str = "updated_at", extracted_at: str | Column | None = None,
                full: bool = False, overlap_seconds: int = 0) -> DataFrame:
    """Extract, write and commit one run; returns the new marks.

    ``full`` reloads everything whatever the marks are; ``overlap_seconds`` re-reads that much
    before them. Tables that this run doesn't name keep their marks.
    """
    spark = next(iter(sources.values())).sparkSession
    batches = write_run(sources, landing, state_root, version, extracted_at, full, overlap_seconds)
    return commit_run(spark, batches, landing, state_root, version)
