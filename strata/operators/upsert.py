"""MERGE into a table partitioned by a hash of its key: only touched partitions are rewritten.

The batch's keys say which partitions it touches. The target is read with a filter on the
partition column (the catalog prunes the rest), merged with the batch by the operators of
``merge``, and the result is written as these partitions' new content. A batch of one key thus reads
and writes one partition of the table, whatever the table's size.

Where the table's format has row-level operations, the same merge is the format's own
(``DataFrame.mergeInto``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import (Cond, batch_size, estimated_row_bytes, insert_frames, merge_small_batch,
                                    require_unique)
from strata.session import written
from strata.sources import tables
from strata.sources.tables import PART

#: Formats whose tables Spark can merge into by rows.
ROW_LEVEL = ("delta", "iceberg", "hudi")


def parts_for(rows: int, schema, part_bytes: int = 256 << 20, least: int = 16) -> int:
    """Hash partitions for a table that begins with so many rows: each holds about ``part_bytes``
    of them, with room to grow."""
    return max(least, -(-rows * estimated_row_bytes(schema) // part_bytes))


#: A step over many rows runs in passes, each over about so many bytes of them, but in no more than
#: so many: what a pass shuffles and spills is gone before the next one. A merge's pass reads its own
#: partitions of the table; one that computes a part of a batch reads all that the batch is made from.
PASS_BYTES, MERGE_PASSES, SOURCE_PASSES = 64 << 20, 4, 2


def passes_for(rows: int, schema, most: int) -> int:
    """Passes for a step that shuffles so many rows."""
    return max(1, min(most, rows * estimated_row_bytes(schema) // PASS_BYTES))


def touched_parts(df: DataFrame) -> list[int]:
    """The partitions that rows of ``df`` are in: at most as many numbers as the table has parts."""
    return sorted(r[0] for r in df.select(PART).distinct().collect())


def with_part(df: DataFrame, target: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """``df`` with its keys in the target's types, and the partition that they belong to."""
    typed = {k: F.col(k).cast(target.schema[k].dataType) for k in keys
             if df.schema[k].dataType != target.schema[k].dataType}
    return df.withColumns(typed).withColumn(PART, tables.part_of(keys, parts))


def _by_name(side: str):
    class Row:
        def __getitem__(self, name: str) -> Column:
            return F.col(f"{side}.{name}")
    return Row()


def _merge_rows(source: DataFrame, name: str, keys: Sequence[str], update_when: Cond,
                insert_when: Callable) -> None:
    t, s = _by_name(name), _by_name("s")
    on = reduce(lambda a, b: a & b, [t[k] == s[k] for k in keys])
    (source.alias("s").mergeInto(name, on).whenMatched(update_when(t, s)).updateAll()
     .whenNotMatched(insert_when(s)).insertAll().merge())


def merge_into(name: str, source: DataFrame, keys: Sequence[str], root: str, *,
               update_when: Cond, insert_when: Callable,
               stale: DataFrame | None = None,
               cluster: Callable[[DataFrame], DataFrame] | None = None,
               properties: dict[str, str] | None = None, part_bytes: int = 256 << 20,
               parts: int | None = None, max_batch_rows: int = 1_000_000,
               stands: bool = False, rows: int = 0) -> list[int]:
    """Merge ``source`` into the table ``name``; returns the partitions that were rewritten.

    A table that isn't there yet is made with ``source``'s columns. ``stale`` holds keys whose rows
    leave the table, after the merge. ``cluster`` lays out the rewritten rows (same rows; the
    column ``_part`` comes first in its order); by default each partition is files of the advisory
    size. ``properties`` (marks) are set once the data stands, also if nothing was touched. A key
    that ``source`` holds twice fails the merge before anything changes. ``source`` is written once to
    the scratch area, for its size and the joins that use it, and removed when the merge is done
    (``stands``: the caller has written it already). ``rows`` is what ``source`` is computed from, if
    it shuffles them by ``keys``: many are taken in passes. The merge itself takes the touched
    partitions in passes. Where they have no rows yet, as on a first load, nothing is joined.
    """
    spark, keys = source.sparkSession, list(keys)
    if tables.row_level(spark, name, ROW_LEVEL):
        _merge_rows(source, name, keys, update_when, insert_when)
        tables.set_properties(spark, name, properties or {})
        return []
    if not stands:
        with written(source, "merge-source", keys,
                     passes_for(rows, source.schema, SOURCE_PASSES)) as source:
            return _merge_parts(name, source, keys, root, update_when, insert_when, stale, cluster,
                                properties, part_bytes, parts, max_batch_rows)
    return _merge_parts(name, source, keys, root, update_when, insert_when, stale, cluster, properties,
                        part_bytes, parts, max_batch_rows)


def _merge_parts(name: str, source: DataFrame, keys: list[str], root: str, update_when: Cond,
                 insert_when: Callable, stale: DataFrame | None, cluster: Callable | None,
                 properties: dict[str, str] | None, part_bytes: int, parts: int | None,
                 max_batch_rows: int) -> list[int]:
    spark = source.sparkSession
    size = batch_size(source)
    if not spark.catalog.tableExists(name):
        tables.create_parts(spark, name, source.schema, root,
                            parts or parts_for(size[0], source.schema, part_bytes))
    n = int(tables.get_property(spark, name, tables.PARTS))
    table = spark.table(name)
    source = with_part(source, table, keys, n)
    touched = touched_parts(source) if size[0] else []
    with ExitStack() as stack:
        if stale is not None:
            stale = stack.enter_context(written(
                with_part(stale.select(*keys).distinct(), table, keys, n), "merge-stale"))
            touched = sorted({*touched, *touched_parts(stale)})
        if not touched:
            tables.set_properties(spark, name, properties or {})
            return []
        first = {*touched}.isdisjoint(tables.partitions(spark, name))
        held = 0 if first else table.filter(F.col(PART).isin(touched)).count()
        k = min(len(touched), passes_for(size[0] + held, table.schema, MERGE_PASSES))

        def next_state(parts: list[int]) -> DataFrame:
            target = table.filter(F.col(PART).isin(parts)).drop(PART)
            batch = (source if k == 1 else source.filter(F.col(PART).isin(parts))).drop(PART)
            if first:
                require_unique(batch, keys)
                merged = insert_frames(target.schema, batch, insert_when)
            else:
                merged = merge_small_batch(target, batch, keys, update_when=update_when,
                                           insert_when=insert_when, max_batch_rows=max_batch_rows,
                                           checkpointed=size)
            if stale is not None:
                gone = stale if k == 1 else stale.filter(F.col(PART).isin(parts))
                merged = merged.join(gone.select(*keys), keys, "left_anti")
            merged = merged.withColumn(PART, tables.part_of(keys, n))
            return cluster(merged) if cluster else merged.hint("rebalance", PART)
        tables.publish_parts(spark, (next_state(touched[i::k]) for i in range(k)), name, root, touched,
                             properties)
    return touched
