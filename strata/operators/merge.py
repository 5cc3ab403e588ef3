"""Upserts without a row-level table format: MERGE as a join that picks whole rows.

``merge_newer_wins`` (silver) and ``merge_scd1`` (gold) compute the table's next
state from its current state and a batch. Each side is carried as its own prefixed
column set (``_t_*`` / ``_s_*``) with its own never-NULL presence flag — presence is
never guessed from a nullable data column — and one decision column picks the
whole row. Output columns are independent projections, so unused ones prune. Predicates use
SQL three-valued logic with unknown = not true, exactly as a MERGE condition.

Plan: one full-outer sort-merge (or shuffled-hash) join on the key. The source
uniqueness guard is a window over the source keys; it requires the very same
hash partitioning the join does, so it adds no exchange. A source row with a
NULL key never matches (like ``t.k = s.k`` in MERGE), so it is an insert.

When the batch is small against the table, ``merge_small_batch`` avoids moving the
table at all: the table is streamed past a broadcast of the batch (size checked
first, with the full-outer plan as the fallback).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import checkpoint_root

def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def _true(c: Column) -> Column:
    """Unknown counts as not true."""
    return F.coalesce(c, F.lit(False))


def _side(df: DataFrame, prefix: str, presence: Column) -> DataFrame:
    """Prefix every column and add a presence flag that is never NULL on its own side."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns],
                     presence.alias(prefix + "_in"))


def _unique_guard(keys: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """Presence flag of the source that fails the job on a duplicated (non-NULL) key.

    The window partitions by the merge key, which is exactly the distribution the
    join needs next, so the check costs no extra exchange.
    """
    dup = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    nonnull = _all([F.col(k).isNotNull() for k in keys])
    label = ", ".join(names or keys)
    msg = F.lit(f"MERGE source has more than one row for a key in ({label})")
    return F.when(nonnull & dup, F.raise_error(msg)).otherwise(F.lit(True))


class _Row:
    """Field access on one side of the joined frame, by original column name."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def __getitem__(self, name: str) -> Column:
        return F.col(self.prefix + name)


# conditions get the target and source rows: ``lambda t, s: s["v"] > t["v"]``
Cond = Callable[[_Row, _Row], Column]


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                 update_when: Cond, insert_when: Callable[[_Row], Column],
                 prune_missing: bool = False, check_unique: bool = True) -> DataFrame:
    """Next state of ``target`` after merging ``source`` on ``keys``.

    * matched and ``update_when(t, s)`` true -> the source row (columns mapped by
      name; target columns the source lacks keep the target value)
    * matched otherwise -> the target row
    * source only and ``insert_when(s)`` true -> the source row (missing columns NULL)
    * target only -> kept, or dropped when ``prune_missing``

    The result has the target's schema. ``t``/``s`` in the conditions are
    indexable by column name (``s["updated_at"]``).
    """
    keys = list(keys)
    for k in keys:
        if k not in target.columns or k not in source.columns:
            raise ValueError(f"merge key {k!r} missing from target or source")
    scols = set(source.columns)
    t = _side(target, "_t_", F.lit(True))
    s = _side(source, "_s_", F.lit(True))
    if check_unique:
        # partitioned by the renamed join key itself, so the join reuses its exchange
        s = s.withColumn("_s__in", _unique_guard(["_s_" + k for k in keys], keys))
    on = _all([F.col("_t_" + k) == F.col("_s_" + k) for k in keys])
    j = t.join(s, on, "full_outer")

    tr, sr = _Row("_t_"), _Row("_s_")
    t_in, s_in = tr["_in"].isNotNull(), sr["_in"].isNotNull()
    take_source = ((t_in & s_in & _true(update_when(tr, sr)))
                   | (~t_in & s_in & _true(insert_when(sr))))
    keep_target = t_in & (s_in if prune_missing else F.lit(True))
    # _take: TRUE = source row, FALSE = target row, NULL = no row
    decided = j.withColumn("_take", F.when(take_source, True).when(keep_target, False))
    out = []
    for f in target.schema.fields:
        src = sr[f.name].cast(f.dataType) if f.name in scols else tr[f.name]
        out.append(F.when(F.col("_take"), src).otherwise(tr[f.name]).alias(f.name))
    return decided.filter(F.col("_take").isNotNull()).select(*out)


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Fail on a (non-NULL) key that ``source`` has twice, as the merges do; only keys are moved."""
    msg = F.lit(f"MERGE source has more than one row for a key in ({', '.join(keys)})")
    (source.filter(_all([F.col(k).isNotNull() for k in keys])).groupBy(*keys)
     .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1)
     .select(F.raise_error(msg)).collect())


def insert_frames(schema: T.StructType, source: DataFrame,
                  insert_when: Callable[[_Row], Column]) -> DataFrame:
    """``merge_frames`` into a table of this schema without rows: there is nothing to join."""
    sr, scols = _Row("_s_"), set(source.columns)
    s = _side(source, "_s_", F.lit(True))
    return s.filter(_true(insert_when(sr))).select(*[
        (sr[f.name] if f.name in scols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def newer_than(version: Sequence[str] | str) -> Cond:
    """``s.version > t.version`` (lexicographic for a tuple); NULL -> not newer."""
    cols = [version] if isinstance(version, str) else list(version)

    def cond(t: _Row, s: _Row) -> Column:
        out = s[cols[-1]] > t[cols[-1]]
        for c in reversed(cols[:-1]):
            out = (s[c] > t[c]) | ((s[c] == t[c]) & out)
        return out
    return cond


def merge_newer_wins(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                     version: Sequence[str] | str = "updated_at",
                     delete_flag: str = "is_deleted", prune_missing: bool = False,
                     check_unique: bool = True) -> DataFrame:
    """Silver upsert: a newer version replaces the row (delete flag included);
    an unseen key is inserted only when its delete flag is false."""
    return merge_frames(
        target, source, keys,
        update_when=newer_than(version),
        insert_when=lambda s: s[delete_flag] == F.lit(False),
        prune_missing=prune_missing, check_unique=check_unique)


def merge_scd1(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
               prune_missing: bool = False, check_unique: bool = True) -> DataFrame:
    """Gold SCD-1 upsert: match overwrites every column, no match inserts.

    The faithful default never deletes; ``prune_missing=True`` drops target rows
    the (full) source no longer has, e.g. fact lines of an order cancelled later.
    """
    return merge_frames(target, source, keys,
                        update_when=lambda t, s: F.lit(True),
                        insert_when=lambda s: F.lit(True),
                        prune_missing=prune_missing, check_unique=check_unique)


# Estimated in-memory width per value, by type (strings: Spark's default estimate).
_WIDTH = {"string": 20, "boolean": 1, "byte": 1, "short": 2, "int": 4, "date": 4, "float": 4}


def estimated_row_bytes(schema: T.StructType) -> int:
    return 8 + sum(_WIDTH.get(f.dataType.typeName(), 8) for f in schema.fields)


def batch_size(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes in memory: fixed widths and the bytes of the texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    one = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(
        F.sum(reduce(lambda a, b: a + b, texts, F.lit(0)).cast("long")), F.lit(0)).alias("b")).first()
    return one["n"], one["n"] * estimated_row_bytes(df.schema) + one["b"]


def merge_small_batch(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                      update_when: Cond, insert_when: Callable[[_Row], Column],
                      max_batch_rows: int = 1_000_000,
                      max_broadcast_bytes: int = 64 << 20,
                      checkpointed: tuple[int, int] | None = None) -> DataFrame:
    """Same result as ``merge_frames`` (without pruning) for a batch whose size is
    measured to be at most ``max_batch_rows`` rows and ``max_broadcast_bytes`` (fixed
    widths, plus the bytes of its texts); the table itself is never shuffled.

    Above the bound it falls back to the full-outer plan; a key that the batch holds
    twice fails the job on either path. The batch is checkpointed to the shared
    checkpoint folder: it is then computed once for its size and the joins that use
    it, and a lost executor re-reads it instead of replaying its lineage (``checkpointed``: the
    caller has done so, and this is the ``batch_size``).
    """
    if checkpointed is None:
        checkpoint_root(source.sparkSession)
        source = source.checkpoint(eager=True)
    rows, size = checkpointed or batch_size(source)
    if rows > max_batch_rows or size > max_broadcast_bytes:
        return merge_frames(target, source, keys, update_when=update_when,
                            insert_when=insert_when)
    keys = list(keys)
    scols = set(source.columns)
    t = _side(target, "_t_", F.lit(True))
    s = _side(source, "_s_", F.lit(True))
    s = F.broadcast(s.withColumn("_s__in", _unique_guard(["_s_" + k for k in keys], keys)))
    on = _all([F.col("_t_" + k) == F.col("_s_" + k) for k in keys])
    tr, sr = _Row("_t_"), _Row("_s_")
    s_in = sr["_in"].isNotNull()
    # every table row, replaced where a matching batch row wins
    upd = t.join(s, on, "left").withColumn("_take", s_in & _true(update_when(tr, sr)))
    updated = upd.select(*[
        F.when(F.col("_take"), sr[f.name].cast(f.dataType) if f.name in scols else tr[f.name])
        .otherwise(tr[f.name]).alias(f.name) for f in target.schema.fields])
    # batch rows whose key the table lacks: anti join against the matched keys only,
    # distinct, so at most the batch's own (checked) size
    matched = (t.join(s, on, "left_semi")
                .select(*[F.col("_t_" + k).alias("_m_" + k) for k in keys]).distinct())
    m_on = _all([F.col("_s_" + k) == F.col("_m_" + k) for k in keys])
    fresh = (s.join(F.broadcast(matched), m_on, "left_anti")
              .filter(_true(insert_when(sr)))
              .select(*[(sr[f.name].cast(f.dataType) if f.name in scols
                         else F.lit(None).cast(f.dataType)).alias(f.name)
                        for f in target.schema.fields]))
    return updated.unionByName(fresh)
