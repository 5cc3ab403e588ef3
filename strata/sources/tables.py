"""Managed layer tables over Parquet, published as versioned snapshots.

Without a row-level table format a MERGE result cannot be written over the
table it reads. Each write therefore goes to a new version folder
``<root>/<schema>/<table>/v=<n>-<attempt>`` and the catalog entry is repointed once the
write committed. Readers see either the old or the new version, and the
previous version stays for them. Writing the snapshot also cuts the lineage for
the next layer. The folder's name is unique per attempt, so what a crashed write left behind
never stands in the way of the next one. Properties (the marks of the layers) survive a repoint.
New ones are set after it (in one statement with it where the form allows): data without its mark
is applied once more, a mark without its data would lose it.

Three forms:

* partitioned by a hash of the key (``create_parts``, ``publish_parts``): a write holds whole
  partitions, goes to a folder of its own, and only these partitions of the table are repointed.
  What a batch does not touch is neither read nor written. Every partition is either old or new;
  a driver lost between two of them leaves a batch applied in part, with its mark not yet set, so
  the next run applies it again (the merges are idempotent);
* plain: one external table, repointed with ``ALTER TABLE ... SET LOCATION``;
* bucketed by key: each version is its own bucketed, key-sorted table
  ``<name>__v<n>_<attempt>`` and ``<name>`` is a view repointed to it. A join or merge on
  the key then reads the table already hash-partitioned (no exchange on the
  table side; only the other side is shuffled into the bucket count).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def use_namespace(spark: SparkSession, name: str, catalog: str | None = None) -> str:
    """Create if needed and select a namespace (``SET CATALOG`` + ``USE``); returns
    the current ``catalog.namespace``."""
    if catalog:
        spark.sql(f"SET CATALOG {catalog}")
    ensure_namespace(spark, name)
    spark.sql(f"USE {name}")
    return f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _describe(spark: SparkSession, name: str, field: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(f"col_name = '{field}'").collect()
    return rows[0]["data_type"] if rows else None


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and _describe(spark, name, "Type") == "VIEW"


def row_level(spark: SparkSession, name: str, formats: Sequence[str]) -> bool:
    """Whether the table is of a format with row-level operations."""
    return spark.catalog.tableExists(name) and (
        _describe(spark, name, "Provider") or "").lower() in formats


def table_location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    return _describe(spark, name, "Location")


def current_version(spark: SparkSession, name: str) -> int:
    if not spark.catalog.tableExists(name):
        return 0
    if (own := get_property(spark, name, VERSION)) is not None:
        return int(own)
    if is_view(spark, name):
        m = re.search(r"__v(\d+)_", _describe(spark, name, "View Text") or "")
    else:
        m = re.search(r"/v=(\d+)(?:-\w+)?/?$", table_location(spark, name) or "")
    return int(m.group(1)) if m else 0


#: Only properties with this prefix are the layers' own; others belong to the catalog.
OWN_PROPERTIES = "strata."


def get_properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
            if r["key"].startswith(OWN_PROPERTIES)}


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    return get_properties(spark, name).get(key)


def _properties(values: dict[str, str]) -> str:
    return ("TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in values.items()) + ")"
            if values else "")


def set_properties(spark: SparkSession, name: str, values: dict[str, str]) -> None:
    if values:
        kind = "VIEW" if is_view(spark, name) else "TABLE"
        spark.sql(f"ALTER {kind} {name} SET {_properties(values)}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, root: str,
                 partition_by: tuple[str, ...] = (), bucket_by: Sequence[str] = (),
                 buckets: int | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with explicit DDL, as an empty first version."""
    if spark.catalog.tableExists(name):
        return
    ns = name.rpartition(".")[0]
    if ns:
        ensure_namespace(spark, ns)
    if bucket_by and buckets:
        publish(spark, spark.createDataFrame([], schema), name, root, bucket_by=bucket_by,
                buckets=buckets)
        return
    path = f"{root.rstrip('/')}/{name.replace('.', '/')}/v=0"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING parquet{part} LOCATION '{path}'")


def publish(spark: SparkSession, df: DataFrame, name: str, root: str,
            partition_by: tuple[str, ...] = (), bucket_by: Sequence[str] = (),
            buckets: int | None = None, properties: dict[str, str] | None = None) -> int:
    """Write ``df`` as the table's next version and repoint the table; returns n.

    ``properties`` are added to those the table has. A frame with other columns replaces the
    table's schema (the catalog entry is made anew; the files of old versions stay).
    """
    n = current_version(spark, name) + 1
    attempt = uuid.uuid4().hex[:8]
    path = f"{root.rstrip('/')}/{name.replace('.', '/')}/v={n}-{attempt}"
    kept = get_properties(spark, name) | (properties or {})
    ns = name.rpartition(".")[0]
    if ns:
        ensure_namespace(spark, ns)
    if bucket_by and buckets:
        physical = f"{name}__v{n}_{attempt}"
        (df.write.mode("errorifexists").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
           .option("path", path).saveAsTable(physical))
        spark.sql(f"CREATE OR REPLACE VIEW {name} {_properties(kept)} "
                  f"AS SELECT * FROM {physical}")
        return n
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    def plain(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    there = spark.catalog.tableExists(name)
    if there and plain(spark.table(name).schema) != plain(df.schema):
        spark.sql(f"DROP TABLE {name}")  # external: its files stay
        there = False
    if not there:
        spark.sql(f"CREATE TABLE {name} ({ddl(df.schema)}) USING parquet LOCATION '{path}' "
                  + _properties(kept))
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")
        set_properties(spark, name, properties or {})
    return n


# --- tables partitioned by a hash of their key ---------------------------------------------

#: The partition column, and the properties that keep the number of partitions and the writes.
PART, PARTS, VERSION = "_part", "strata.parts", "strata.version"


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The partition of a row: the same on every run, for keys of the table's own types."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def create_parts(spark: SparkSession, name: str, schema: T.StructType, root: str,
                 parts: int) -> None:
    """``CREATE TABLE IF NOT EXISTS`` partitioned into ``parts`` hash partitions, all empty. The
    number stays the table's own; a partition should hold a few hundred MB."""
    if spark.catalog.tableExists(name):
        return
    if "." in name:
        ensure_namespace(spark, name.rpartition(".")[0])
    path = f"{root.rstrip('/')}/{name.replace('.', '/')}/v=0"
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}, {PART} INT) USING parquet "
              f"PARTITIONED BY ({PART}) LOCATION '{path}' "
              + _properties({PARTS: str(parts), VERSION: "0"}))


def partitions(spark: SparkSession, name: str) -> list[int]:
    """Values of a table's one partition column, from the catalog alone."""
    if not spark.catalog.tableExists(name):
        return []
    found = [r["partition"].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return sorted(int(v) for v in found)


def point_partitions(spark: SparkSession, name: str, column: str, paths: dict[int, str]) -> None:
    """Let partitions be what stands in these folders (one without a folder is empty)."""
    have = set(partitions(spark, name))
    new = [f"PARTITION ({column}={v}) LOCATION '{p}'" for v, p in paths.items() if v not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(new))
    for v, p in paths.items():
        if v in have:
            spark.sql(f"ALTER TABLE {name} PARTITION ({column}={v}) SET LOCATION '{p}'")
    spark.sql(f"REFRESH TABLE {name}")


def publish_parts(spark: SparkSession, df: DataFrame | Iterable[DataFrame], name: str, root: str,
                  touched: Sequence[int], properties: dict[str, str] | None = None) -> str:
    """Make ``df`` (with the column ``_part``) what the ``touched`` partitions hold; the others stay
    as they are. Of several frames all are written, one after the other, before the table changes.
    Returns the folder written."""
    n = current_version(spark, name) + 1
    path = f"{root.rstrip('/')}/{name.replace('.', '/')}/v={n}-{uuid.uuid4().hex[:8]}"
    columns = [c for c in spark.table(name).columns if c != PART]
    for rows in [df] if isinstance(df, DataFrame) else df:
        (rows.select(*columns, PART).write.mode("append").option("compression", "zstd")
             .partitionBy(PART).parquet(path))
    point_partitions(spark, name, PART, {p: f"{path}/{PART}={p}" for p in touched})
    set_properties(spark, name, {VERSION: str(n), **(properties or {})})
    return path


# --- append-only history, one partition per batch -------------------------------------------

def create_history(spark: SparkSession, name: str, schema: T.StructType, path: str,
                   column: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over a folder of ``<column>=<n>`` folders. The catalog's
    partitions are the registry of the batches; folders from before are taken up once, here."""
    if spark.catalog.tableExists(name):
        return
    if "." in name:
        ensure_namespace(spark, name.rpartition(".")[0])
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}, {column} BIGINT) USING parquet "
              f"PARTITIONED BY ({column}) LOCATION '{path}'")
    # no rows: makes the folder, if it isn't there
    spark.createDataFrame([], spark.table(name).schema).write.mode("append").partitionBy(column) \
        .parquet(path)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def append(df: DataFrame, name: str) -> None:
    """Append-only history (bronze): new files next to the old ones, by column name."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.mode("append").insertInto(name)
