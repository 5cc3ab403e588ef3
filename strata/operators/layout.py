"""Physical layout: multi-column clustering (Z-order) and file compaction.

Z-order: every clustering column is cut at boundaries taken from a bounded sample of its whole
values (strings as strings, dates as dates), at equal numbers of sampled rows. A value's rank, found
by binary search among the boundaries, is what enters the bit interleave, so skewed numbers and
strings with a long common prefix spread over the ranks as evenly as anything else. Ranks are
interleaved into one LONG key with built-in shift/and expressions, and the data is
range-partitioned on that key (Spark samples the key to pick boundaries) and sorted within
partitions. Files then hold tight (date, customer) boxes, so Parquet min/max statistics
skip row groups for filters on either column.

Compaction: sizes in bytes, as the files have them, decide which partitions of a table are
rewritten, and the rewritten files get about the wanted size.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import tables
from strata.sources.tables import PART

#: Bits of a rank, rows sampled for the boundaries, and characters of a sampled text that a
#: boundary keeps. They bound what the driver gets, and touch the layout only, never the rows.
BITS, SAMPLE_ROWS, TEXT = 10, 100_000, 256


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS,
                sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """``2**bits - 1`` ascending boundaries of each column, from a sample of about
    ``sample_rows`` rows (all rows where there are fewer). A frequent value stands as often as it
    fills: ranks use all their bits, whatever the number of distinct values."""
    rows = df.select(*columns)
    n = rows.count()
    if n > sample_rows:
        rows = rows.sample(sample_rows / n, seed=7)

    def values(c: str) -> Column:
        value = F.col(c)
        if isinstance(df.schema[c].dataType, T.StringType):
            value = F.substring(value, 1, TEXT)
        return F.sort_array(F.collect_list(value)).alias(c)  # NULLs are left out

    def cut(c: str) -> Column:
        at, size = F.sequence(F.lit(1), F.lit((1 << bits) - 1)), F.size(c)
        return F.transform(at, lambda i: F.get(
            F.col(c), F.least((i * size / (1 << bits)).cast("int"), size - 1))).alias(c)
    # sorted first, then cut: inside the cuts the sort would run once for each of them
    one = rows.agg(*[values(c) for c in columns]).select(*[cut(c) for c in columns]).first()
    return {c: [v for v in one[c] if v is not None] for c in columns}


def _literal(v, dtype: T.DataType) -> str:
    """A boundary as SQL text."""
    if isinstance(v, str):
        return f"CAST(X'{v.encode().hex()}' AS STRING)"
    return f"CAST('{v}' AS {dtype.simpleString()})"


def rank(c: str, dtype: T.DataType, bounds: Sequence, bits: int = BITS) -> Column:
    """How many boundaries are not above the value (0 for NULL), by binary search."""
    if not bounds:
        return F.lit(0)
    held = f"array({', '.join(_literal(v, dtype) for v in bounds)})"
    steps = f"array({', '.join(str(1 << i) for i in reversed(range(bits)))})"
    name = "`" + c.replace("`", "``") + "`"
    # beyond the end of the array: NULL, which is not true
    return F.expr(f"aggregate({steps}, 0, (at, step) -> at + IF(get({held}, at + step - 1) <= {name}, step, 0))")


def zorder_key(ranks: Sequence[str], bits: int = BITS) -> Column:
    """Interleave the bits of the rank columns into one LONG (bit i of column j lands at position
    i * k + (k - 1 - j))."""
    k = len(ranks)
    if k * bits > 63:
        raise ValueError(f"{k} columns of {bits} bits don't fit one LONG")
    return F.expr(" | ".join(
        f"shiftleft(shiftright(CAST({x} AS BIGINT), {i}) & 1L, {i * k + (k - 1 - j)})"
        for i in range(bits) for j, x in enumerate(ranks)))


def zorder(df: DataFrame, columns: Sequence[str], num_partitions: int | None = None,
           bits: int = BITS, bounds: dict[str, list] | None = None,
           within: str | None = None) -> DataFrame:
    """Rows of ``df`` clustered by the Z-order of ``columns`` (same rows, new layout), inside each
    value of ``within`` if that is given.

    ``bounds`` can come from somewhere cheaper than ``df`` itself (the change batch, a
    dimension), which saves a pass over ``df``; boundaries that don't fit the data
    cost clustering quality, never rows.
    """
    known = dict(bounds or {})
    missing = [c for c in columns if c not in known]
    if missing:
        known |= rank_bounds(df, missing, bits)
    ranks = [f"_r{i}" for i in range(len(columns))]
    # Without an explicit count AQE sizes the range partitions (and so the written
    # files) to the advisory partition size; an explicit count is kept as given.
    # A hot value (a third of all rows on one date and customer) gives one Z value;
    # the row-content hash behind it lets range partitioning split such a run over
    # several partitions. It is deterministic, so a retried task sees the same ranges.
    ranked = df.withColumns({f"_r{i}": rank(c, df.schema[c].dataType, known[c], bits)
                             for i, c in enumerate(columns)})
    keyed = ranked.withColumns({"_z": zorder_key(ranks, bits),
                                "_t": F.xxhash64(*[F.col(c) for c in df.columns])})
    by = [*([within] if within else []), "_z", "_t"]
    ranged = (keyed.repartitionByRange(num_partitions, *by) if num_partitions
              else keyed.repartitionByRange(*by))
    return ranged.sortWithinPartitions(*by).select(*df.columns)


def file_sizes(df: DataFrame, *by: str) -> DataFrame:
    """(*by, files, bytes): the files under a table scan. No column of the data is read."""
    files = df.select(*by, "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy(*by).agg(F.count("file_path").alias("files"),
                                  F.sum("file_size").alias("bytes"))


@contextmanager
def _advisory(spark: SparkSession, size: int):
    """Partitions of about ``size`` bytes while a write runs."""
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, str(size))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compact_parts(spark: SparkSession, name: str, root: str, among: Sequence[int] | None = None,
                  target_bytes: int = 128 << 20) -> list[int]:
    """Rewrite the partitions (``among`` these, or all) of a hash-partitioned table that have more
    files than their bytes fill at ``target_bytes`` each; returns them. Others are not read."""
    table = spark.table(name)
    if among is not None:
        if not among:
            return []
        table = table.filter(F.col(PART).isin(list(among)))
    scattered = file_sizes(table, PART).filter(
        F.col("files") > F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)))
    parts = sorted(r[PART] for r in scattered.select(PART).collect())
    if parts:
        with _advisory(spark, target_bytes):
            tables.publish_parts(spark, spark.table(name).filter(F.col(PART).isin(parts))
                                 .hint("rebalance", PART), name, root, parts)
    return parts
